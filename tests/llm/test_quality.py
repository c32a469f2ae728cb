"""Quality rules against a plain Python count."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import quality
from tidemark.llm.queries import op5_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = WORD.findall(text)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
            len(w) < 50 or 100 * len(repeated) > 50 * len(w))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
TEXTS = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "é ü $$ <b> 𝒳",
         "w " * 20000, " ".join(map(str, range(300))), "one two three four\n" * 80, "a b c\x0bd\x0ce", "line\r\nline\r\n",
         " ".join(f"w{i % 70}" for i in range(200)), "a b c d a b c e a b"]


def test_counts(spark):
    df = spark.createDataFrame([(i, t, None if i % 3 == 0 else "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in quality.quality(df).collect()}
    assert got == {i: base(t) for i, t in enumerate(TEXTS)}


def test_very_long_text_without_repeats(spark):
    df = spark.range(2).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(6_000_000)), lambda i: F.conv(i.cast("string"), 10, 36))),
        F.when(F.col("id") == 1, " x y z x y z").otherwise("")).alias("text"))
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in quality.quality(df.repartition(2)).collect()}
    assert got == {0: (6_000_001, 0), 1: (6_000_007, 6)}


def test_nulls_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b c", None, 1), (1, None, "xx", 2), (1, None, "xx", 2)], "doc_id long, text string, lang string, KEPT int")
    rows = quality.quality(df).collect()
    assert len(rows) == 3 and not any(r.kept for r in rows)
    assert quality.quality(df.limit(0)).collect() == []
    assert quality.drop_low_quality(df).columns == df.columns


def test_divergence_against_formula(spark):
    prose = ["the of and to a in is that for it " * 4 + " ".join(f"word{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}" for j in range(80)) for i in range(30)]
    odd = "%%% ### " * 200 + " ".join(f"A{i}Z" for i in range(60))
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*prose, odd])], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in quality.quality(df).collect()}
    classes = [str.islower, str.isupper, str.isdigit, lambda c: c in "#*$%&|<>", lambda c: c < "\x80", lambda c: True]

    def shares(text):
        solid = "".join(WORD.findall(text))
        counts = [0] * 6
        for c in solid:
            counts[next(k for k, f in enumerate(classes) if f(c) and (k > 2 or c < "\x80"))] += 1
        return [c / len(solid) for c in counts]

    every = [shares(t) for t in [*prose, odd]]
    mean = [sum(c) / len(every) for c in zip(*every, strict=True)]

    def distance(p, q):
        total = sum(0.5 * x * math.log2(2 * x / (p[i] + q[i])) for v in (p, q) for i, x in enumerate(v) if x)
        return math.sqrt(max(total, 0))

    for i, p in enumerate(every):
        assert rows[i].char_distance == pytest.approx(distance(p, mean), abs=1e-9)
    assert rows[0].word_distance < rows[30].word_distance and not rows[30].kept


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op5_quality_rules(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: base(r.text) for r in docs}


def test_kept_rows_pass_the_base_rules(spark):
    assert op5_quality_rules(spark, SF).where(F.col("base_failed") & F.col("kept")).count() == 0
