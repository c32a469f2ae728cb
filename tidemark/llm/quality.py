"""Quality rules: base counts and distribution divergence, in DataFrame functions only.

For every whole text: word counts, symbols, repeated lines and repeated three-word windows, and two
histograms: character classes (lower case, upper case, digits, symbols, other ASCII marks, other
characters) and the common words of the row's language (plus all other words).  The reference of a
language is the mean histogram of its documents.  A document fails if the Jensen-Shannon distance (base
2, between 0 and 1) of a histogram to its reference passes a threshold; short documents are not
compared (minimum-length guards).

Words are runs of characters other than space and U+0009 to U+000D.  The array functions keep every
count inside its row: no text is exploded or shuffled.

Defined results: a null text has no words and fails the base rules; a null or unknown language is
compared by character classes only, with the reference of the rows that share it; an empty table has
no references and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, stored

# FIXED VALUES: the word rule, the symbol list and the base limits of the contract.
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# Common words of four languages, the usual first entries of any frequency list.
COMMON_WORDS: dict[str, list[str]] = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "on", "as", "with", "was", "are", "be"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
#: Guards and thresholds of the divergence rules.
MIN_CHARS_COMPARED = 200
MIN_WORDS_COMPARED = 100
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.27
#: References have one row per language value; above this many they are joined by shuffle.
MAX_BROADCAST_LANGUAGES = 10_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def _removed(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def repeated_windows(step: DataFrame) -> DataFrame:
    """Adds ``__at``: the sorted places of the three-word windows that the text in ``__words`` holds twice or more.

    Most texts have as many different window hashes as windows, and none is repeated.  In the others the windows are
    sorted by two whole 64-bit hashes and their place; neighbours that agree in both, and in their words, are repeats."""
    word = lambda i: F.get("__words", i)
    places = F.when(F.col("__n") >= 3, F.sequence(F.lit(0), (F.col("__n") - 3).cast("int"))).otherwise(F.array().cast("array<int>"))
    step = step.withColumn("__hashes", F.transform(places, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    keys = F.sort_array(F.transform("__hashes", lambda h, i: F.struct(
        h.alias("h"), F.xxhash64(F.lit(1), word(i + 2), word(i + 1), word(i)).alias("g"), i.alias("i"))))
    step = step.withColumn("__keys", F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), keys))

    def same(x, y):
        agree = (x["h"] == y["h"]) & (x["g"] == y["g"])
        for k in range(3):
            agree = agree & (word(x["i"] + k) == word(y["i"] + k))
        return F.coalesce(agree, F.lit(False))

    repeated = F.filter("__keys", lambda x, i: same(x, F.get("__keys", i + 1)) | same(x, F.get("__keys", i - 1)))
    return step.withColumn("__at", F.sort_array(F.transform(
        F.coalesce(repeated, F.array().cast("array<struct<h:bigint,g:bigint,i:int>>")), lambda x: x["i"])))


def text_measures(documents: DataFrame) -> DataFrame:
    """``documents`` (with doc_id, lang, text and any others) plus the private columns of all measures."""
    step = documents.withColumn("__words", words_of(F.col("text")))
    step = step.withColumn("__n", F.size("__words").cast("long"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = step.withColumn("__lines", lines)
    step = repeated_windows(step)
    step = step.withColumn("__gaps", F.transform("__at", lambda x, i: F.least(
        F.lit(3), F.coalesce(F.get("__at", i + 1) - x, F.lit(3))).cast("long")))
    step = step.withColumn("__repeat_words", F.aggregate("__gaps", F.lit(0).cast("long"), lambda a, x: a + x))
    return _histograms(step).withColumn("__dup_lines", F.size("__lines") - F.size(F.array_distinct("__lines"))).drop(
        "__lines", "__hashes", "__keys", "__at", "__gaps")


def _histograms(step: DataFrame) -> DataFrame:
    """Counts by character class and by common word of the row's language, from ``__words`` and ``__n``."""
    step = step.withColumn("__solid", F.array_join("__words", ""))
    step = step.withColumn("__word_chars", F.length("__solid").cast("long"))
    step = step.withColumn("__no_lower", _removed(F.col("__solid"), "[a-z]+"))
    step = step.withColumn("__no_upper", _removed(F.col("__no_lower"), "[A-Z]+"))
    step = step.withColumn("__no_digit", _removed(F.col("__no_upper"), "[0-9]+"))
    step = step.withColumn("__no_symbol", _removed(F.col("__no_digit"), "[#*$%&|<>]+"))
    step = step.withColumn("__foreign", _removed(F.col("__no_symbol"), r"[\x00-\x7F]+"))
    size = [F.length(c) for c in ("__solid", "__no_lower", "__no_upper", "__no_digit", "__no_symbol", "__foreign")]
    step = step.withColumn("__symbols", (size[3] - size[4]).cast("long"))
    step = step.withColumn("__chars", F.array(*[(a - b).cast("double") for a, b in zip(size, [*size[1:], F.lit(0)], strict=True)]))
    # the common words of the row, each between bars: a word's count follows from the length that its
    # removal takes away
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    step = step.withColumn("__common", F.concat(F.lit("|"), F.array_join(F.filter(
        "__words", lambda x: x.isin(every)), "||"), F.lit("|")))

    def count(word: str) -> Column:
        gone = F.length("__common") - F.length(F.replace(F.col("__common"), F.lit(f"|{word}|"), F.lit("")))
        return (gone / (len(word) + 2)).cast("double")

    counts = F.array().cast("array<double>")
    for lang, words in COMMON_WORDS.items():
        counts = F.when(F.col("lang") == lang, F.array(*map(count, words))).otherwise(counts)
    step = step.withColumn("__counts", counts)
    step = step.withColumn("__word_counts", F.concat("__counts", F.array(
        F.col("__n") - F.aggregate("__counts", F.lit(0.0), lambda a, x: a + x))))
    return step.drop("__no_lower", "__no_upper", "__no_digit", "__no_symbol", "__foreign", "__solid",
                     "__common", "__counts", "__words")


def _share(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def histograms(documents: DataFrame) -> DataFrame:
    """Only the measures that the references need."""
    step = documents.select("lang", "text").withColumn("__words", words_of(F.col("text")))
    return _histograms(step.withColumn("__n", F.size("__words").cast("long")))


def language_references(measures: DataFrame) -> DataFrame:
    """(lang key, mean character-class histogram, mean common-word histogram) over all documents long
    enough to be compared."""
    step = measures.select(
        F.coalesce("lang", F.lit("")).alias("__lang"),
        F.when(F.col("__word_chars") >= MIN_CHARS_COMPARED, _share(F.col("__chars"), F.col("__word_chars"))).alias("c"),
        F.when(F.col("__n") >= MIN_WORDS_COMPARED, _share(F.col("__word_counts"), F.col("__n"))).alias("w"))
    n_words = max(map(len, COMMON_WORDS.values())) + 1
    means = step.groupBy("__lang").agg(*[F.avg(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(6)],
                                       *[F.avg(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(n_words)])
    return cut(means.select("__lang", F.array(*[f"c{i}" for i in range(6)]).alias("__ref_chars"),
                            F.array(*[f"w{i}" for i in range(n_words)]).alias("__ref_words")))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance (square root of the divergence, base 2) of two histograms; null if one is null."""
    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(p, F.slice(q, 1, F.size(p)), lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def with_verdicts(measures: DataFrame, refs: DataFrame) -> DataFrame:
    """The measured rows with distances, ``__base_failed`` and ``__kept``."""
    small = refs.count() <= MAX_BROADCAST_LANGUAGES
    step = measures.withColumn("__lang", F.coalesce("lang", F.lit("")))
    step = step.join(F.broadcast(refs) if small else refs, "__lang", "left")
    step = step.withColumn("__char_distance", F.when(
        F.col("__word_chars") >= MIN_CHARS_COMPARED,
        jensen_shannon(_share(F.col("__chars"), F.col("__word_chars")), F.col("__ref_chars"))))
    step = step.withColumn("__word_distance", F.when(
        (F.col("__n") >= MIN_WORDS_COMPARED) & (F.size("__word_counts") > 1),
        jensen_shannon(_share(F.col("__word_counts"), F.col("__n")), F.col("__ref_words"))))
    step = step.withColumn("__base_failed", (F.col("__n") < MIN_WORDS)
                           | (100 * F.col("__repeat_words") > MAX_REPEATED_PERCENT * F.col("__n")))
    return step.withColumn("__kept", ~F.col("__base_failed")
                           & (F.coalesce("__char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE)
                           & (F.coalesce("__word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE))


def quality(documents: DataFrame) -> DataFrame:
    """Per document row: counts, distances (null below the guards) and verdicts.

    The measures (a few numbers a row) are written once; references and verdicts read them, not the texts."""
    measures = stored(text_measures(documents.select("doc_id", "lang", "text")).drop("text"))
    return with_verdicts(measures, language_references(measures)).select(
        "doc_id", F.col("__n").alias("n_words"), F.col("__word_chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"), F.col("__dup_lines").cast("long").alias("n_dup_lines"),
        F.col("__repeat_words").alias("n_repeat_words"), F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"), F.col("__char_distance").alias("char_distance"),
        F.col("__word_distance").alias("word_distance"))


def drop_low_quality(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns kept."""
    # the random column keeps the filter above the projections: pushed below them, its condition would
    # hold every measure many times over
    judged = with_verdicts(text_measures(documents), language_references(histograms(documents))).withColumn("__hold", F.rand())
    return judged.where("__kept and __hold >= 0").select(*[f"`{c}`" for c in documents.columns])
