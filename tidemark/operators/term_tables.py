"""Keyword, category and lexicon tables (SRC9, J5) and the text features joined from them (STR2-STR4, STR6, STR7).

The expressions of ``functions.keywords`` and ``functions.sentiment`` hold their words in the plan, which fits lists of
tens of words.  Here the words are DataFrames of any length (100,000 keywords are a table, not a plan), and texts meet
them by equi-joins:

lexicon
    Every token occurrence looks itself up once.  A booster or negation that was found is sent to the positions it acts
    on (the next one, the next three), so one aggregate by (row, position) brings a scored token and its modifiers together.

keywords and categories
    A term without a blank that occurs in a text occurs inside one of its blank-separated pieces, a term with k blanks inside
    k + 1 consecutive pieces.  The distinct pieces of the whole corpus (a partial aggregate: frequent words meet here
    once) are joined with the terms on a term's first characters and compared whole; what matched is looked up by the rows.

``lookup`` broadcasts a table of at most BROADCAST_ROWS rows; a longer one is joined by a shuffle in which the most
frequent keys are spread over SALTS tasks.

Defined results: a null text scores 0 everywhere; an empty term occurs in every text that is not null; null terms and tokens
are ignored; a term listed twice in one tier counts once, in two tiers twice; an entry listed twice in the lexicon takes the
larger of each value; rows must have a unique, non-null ``row_id``; empty tables give zeros and no mention columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import (TIER_POINTS, VADER_ALPHA, VADER_BOOSTER_INCREMENT, VADER_EXCLAMATION_INCREMENT,
                             VADER_MAX_EXCLAMATIONS, VADER_NEGATION_SCALAR, Lexicon)
from tidemark.functions.keywords import DEFAULT_TYPE_TO_CATEGORY, price_stress
from tidemark.functions.numeric import combined_sentiment
from tidemark.functions.text import headline_length, tokens, word_count
from tidemark.session import stored

BROADCAST_ROWS = 200_000
HOT_KEYS = 100  # the most frequent keys of a shuffled lookup are spread; any other holds under 1 % of the rows
SALTS = 32
ANCHOR = 4  # a term is found by its first characters, at most this many


def keyword_table(spark: SparkSession, tiers: Mapping[str, Sequence[str]],
                  points: Mapping[str, int] = TIER_POINTS) -> DataFrame:
    """(tier, term, points) of keyword lists."""
    rows = [(tier, w, int(points.get(tier, 0))) for tier, words in tiers.items() for w in dict.fromkeys(words)]
    return spark.createDataFrame(rows, "tier string, term string, points int")


def category_table(spark: SparkSession, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """(category, term) of category lists."""
    rows = [(cat, w) for cat, words in categories.items() for w in dict.fromkeys(words)]
    return spark.createDataFrame(rows, "category string, term string")


def lexicon_table(spark: SparkSession, lex: Lexicon) -> DataFrame:
    """(token, valence, polarity, subjectivity, booster, negation) of a lexicon: one row per token."""
    known = sorted({*lex.valence, *lex.polarity, *lex.subjectivity, *lex.boosters, *lex.negations})
    rows = [(t, *[None if (v := d.get(t)) is None else float(v) for d in (lex.valence, lex.polarity, lex.subjectivity, lex.boosters)],
             t in lex.negations) for t in known]
    return spark.createDataFrame(rows, "token string, valence double, polarity double, subjectivity double, booster double, negation boolean")


def lookup(rows: DataFrame, table: DataFrame, key: str, spread: Sequence[str],
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` on ``key``: broadcast up to ``broadcast_rows`` rows of the table, else a
    shuffle join with the most frequent keys of ``rows`` spread by the hash of the ``spread`` columns."""
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), key)
    found = rows.groupBy(key).count().orderBy(F.col("count").desc(), key).limit(HOT_KEYS)
    hot = [r[0] for r in found.select(F.xxhash64(key)).collect()]  # at most HOT_KEYS hashes
    is_hot = F.xxhash64(key).isin(hot)
    left = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    places = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(table.withColumn("_salt", F.explode(places)), [key, "_salt"]).drop("_salt")


def lexicon_scores(df: DataFrame, lexicon: DataFrame, text: str = "headline",
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(row_id, _valence, sentiment_polarity, sentiment_subjectivity) of the rows with a scored token."""
    entries = lexicon.where(F.col("token").isNotNull()).groupBy("token").agg(
        *[F.max(c).alias(c) for c in ("valence", "polarity", "subjectivity", "booster", "negation")])
    places = df.select("row_id", F.posexplode(tokens(text)).alias("pos", "token"))
    hits = lookup(places, entries, "token", ("row_id", "pos"), broadcast_rows)
    none = F.lit(None)

    def event(offset: int, scored: bool = False, booster: bool = False, negation: bool = False) -> Column:
        value = lambda c, on: (F.col(c) if on else none).cast("double").alias(c)
        return F.struct((F.col("pos") + offset).alias("at"), value("valence", scored), value("polarity", scored),
                        value("subjectivity", scored), value("booster", booster), F.lit(negation).alias("negated"),
                        F.lit(negation and offset == 1).alias("negated_next"))

    is_scored = F.coalesce("valence", "polarity", "subjectivity").isNotNull()
    no_events = F.array().cast(hits.select(F.array(event(0))).schema[0].dataType)
    events = F.concat(
        F.when(is_scored, F.array(event(0, scored=True))).otherwise(no_events),
        F.when(F.col("booster").isNotNull(), F.array(event(1, booster=True))).otherwise(no_events),
        F.when(F.col("negation"), F.array(*[event(i, negation=True) for i in (1, 2, 3)])).otherwise(no_events))
    at = hits.select("row_id", F.explode(events).alias("e")).select("row_id", "e.*").groupBy("row_id", "at").agg(
        *[F.max(c).alias(c) for c in ("valence", "polarity", "subjectivity", "booster", "negated", "negated_next")]).where(is_scored)
    v = F.coalesce("valence", F.lit(0.0))
    v = v + F.signum(v) * F.coalesce("booster", F.lit(0.0)) * F.lit(VADER_BOOSTER_INCREMENT)
    at = at.select("row_id", F.struct(
        "at", F.when(F.col("negated"), v * F.lit(VADER_NEGATION_SCALAR)).otherwise(v).alias("v"),
        (F.col("polarity") * F.when(F.col("negated_next"), -0.5).otherwise(1.0)).alias("p"), F.col("subjectivity").alias("s")).alias("x"))
    # a text's values are added up in its own order (at most one per token), so that no partitioning changes a last digit
    values = at.groupBy("row_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def total(name: str) -> Column:
        return F.aggregate("xs", F.lit(0.0), lambda acc, x: acc + F.coalesce(x[name], F.lit(0.0)))

    def mean(name: str) -> Column:
        return F.try_divide(total(name), F.size(F.filter("xs", lambda x: x[name].isNotNull())).cast("double"))

    return values.select("row_id", total("v").alias("_valence"), mean("p").alias("sentiment_polarity"), mean("s").alias("sentiment_subjectivity"))


def term_matches(df: DataFrame, terms: DataFrame, text: str = "headline",
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct (row_id, entry) where the lower-cased ``term`` of (entry, term) is contained in the lower-cased text."""
    terms = stored(terms.where(F.col("term").isNotNull()).select("entry", F.lower("term").alias("term")).distinct()
                   .withColumn("blanks", F.length("term") - F.length(F.replace("term", F.lit(" "), F.lit("")))))
    shapes = [tuple(r) for r in terms.select("blanks", F.least(F.length("term"), F.lit(ANCHOR))).distinct().collect()]  # word counts of terms
    blanks, sizes = sorted({b for b, _ in shapes}), sorted({s for _, s in shapes})
    if not shapes:
        return df.select("row_id", F.lit(None).cast(terms.schema["entry"].dataType).alias("entry")).limit(0)
    # windows of b + 1 blank-separated pieces; joined with one blank they are the text itself
    df = df.where(F.col(text).isNotNull()).select("row_id", F.split(F.lower(text), " ").alias("p"))

    def windows(b: int) -> Column:
        starts = F.when(F.size("p") > b, F.sequence(F.lit(1), F.size("p") - b)).otherwise(F.array().cast("array<int>"))
        found = F.col("p") if b == 0 else F.transform(starts, lambda i: F.array_join(F.slice("p", i, b + 1), " "))
        return F.transform(F.array_distinct(found), lambda w: F.struct(F.lit(b).alias("blanks"), w.alias("w")))

    pieces = df.select("row_id", F.explode(F.concat(*[windows(b) for b in blanks])).alias("x")).select("row_id", "x.*")
    chars = F.split("w", "")
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.size("c"), F.lit(1))), lambda i: F.array(
        *[F.array_join(F.slice("c", i, s), "") for s in sizes])))
    vocabulary = pieces.select("blanks", "w").distinct().select("blanks", "w", chars.alias("c"))
    vocabulary = vocabulary.select("blanks", "w", F.explode(F.array_distinct(grams)).alias("anchor"))
    anchored = terms.withColumn("anchor", F.substring("term", 1, ANCHOR)).withColumnRenamed("blanks", "_b")
    matched = lookup(vocabulary, anchored, "anchor", ("w",), broadcast_rows).where(
        (F.col("blanks") == F.col("_b")) & F.contains("w", "term"))
    matched = stored(matched.select("w", "entry").distinct())
    return lookup(pieces.select("row_id", "w"), matched, "w", ("row_id",), broadcast_rows).select("row_id", "entry").distinct()


def text_features_from_tables(df: DataFrame, keywords: DataFrame, categories: DataFrame, lexicon: DataFrame,
                              type_to_category: Mapping[str, str] = DEFAULT_TYPE_TO_CATEGORY,
                              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The columns of ``composite.text_features`` from a keyword table (tier, term, points), a category table (category,
    term) and a lexicon table."""
    label = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).alias("label"), F.col("term").alias("listed"))
    terms = keywords.select(label("tier", "tier").alias("entry"), "term", "points").unionByName(
        categories.select(label("category", "category").alias("entry"), "term", F.lit(0).alias("points")))
    listed = terms.groupBy("entry").agg(F.max("points").alias("points"))
    matches = lookup(term_matches(df, terms, broadcast_rows=broadcast_rows), listed, "entry", ("row_id",), broadcast_rows)
    names = sorted(r[0] for r in categories.select("category").where("category IS NOT NULL").distinct().collect())  # output columns
    by_row = matches.groupBy("row_id").agg(F.sum("points").cast("double").alias("_points"), *[
        F.max(((F.col("entry.kind") == "category") & (F.col("entry.label") == c)).cast("int")).alias(f"_m{i}") for i, c in enumerate(names)])
    h, has_change = F.col("headline"), "change_percent" in df.columns
    type_col = next((c for c in ("asset_type", "type") if c in df.columns), None)
    bangs = F.least(F.length(h) - F.length(F.replace(h, F.lit("!"), F.lit(""))), F.lit(VADER_MAX_EXCLAMATIONS))
    base = df.select("*", headline_length(h).alias("headline_length"), word_count(h).alias("word_count"), bangs.alias("_bangs"))
    out = base.join(lexicon_scores(df, lexicon, broadcast_rows=broadcast_rows), "row_id", "left").join(by_row, "row_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    s = zero("_valence")
    s = F.when(s != 0, s + F.signum(s) * F.col("_bangs") * F.lit(VADER_EXCLAMATION_INCREMENT)).otherwise(s)
    out = out.withColumns({"sentiment_polarity": zero("sentiment_polarity"), "sentiment_subjectivity": zero("sentiment_subjectivity"),
                           "vader_compound": F.round(s / F.sqrt(s * s + F.lit(VADER_ALPHA)), 4)})
    flags = []
    for i, c in enumerate(names):
        types = [t for t, category in type_to_category.items() if category == c]
        flag = F.coalesce(F.col(f"_m{i}"), F.lit(0))
        flags.append((F.when(F.col(type_col).isin(types), 1).otherwise(flag) if types and type_col else flag).cast("int").alias(f"mentions_{c}"))
    points = zero("_points") + (price_stress("change_percent") if has_change else F.lit(0.0))
    return out.select("*", combined_sentiment("vader_compound", "change_percent" if has_change else None).alias("combined_sentiment"),
                      points.alias("keyword_stress_score"), *flags).drop("_valence", "_points", "_bangs", *[f"_m{i}" for i in range(len(names))])
