"""Text expressions: FIXTURES F3 cleaning and list parsing, D28, word counts, keywords, sentiment."""

from pyspark.sql import functions as F

from tidemark.config import ASSET_CATEGORIES, SEED_LEXICON, STRESS_KEYWORDS
from tidemark.functions.keywords import keyword_points, mention_columns, price_stress
from tidemark.functions.sentiment import compound, polarity_subjectivity
from tidemark.functions.text import clean_text, parse_list, price_suffix, word_count


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_text_cases(spark):
    cases = [
        (None, ""),
        ("", ""),
        ("Short one", "Short one"),
        ("Markets fall  sharply...!? today", "Markets fall sharply? today"),
        ('S&P 500 "café" rises +1.5% to $5,000', "SP 500 café rises +1.5% to $5,000"),
        ("  tabs\tand\nnew lines  ", "tabs and new lines"),
        ("Ünïcödé wörds stay_ok", "Ünïcödé wörds stay_ok"),
    ]
    df = spark.createDataFrame(cases, "v string, want string")
    got = df.select(clean_text("v").alias("got"), "want").collect()
    for r in got:
        assert r["got"] == r["want"]


def test_parse_list(spark):
    df = spark.createDataFrame([("['a','b']",), ("abc",), ("",), (None,), ("[broken",)], "v string")
    got = [r["r"] for r in df.select(parse_list("v").alias("r")).collect()]
    assert got == [["a", "b"], ["abc"], [], [], ["[broken"]]


def test_price_suffix_null_price(spark):
    df = spark.createDataFrame([("x", 12.345), ("y", None)], "s string, p double")
    got = [r["r"] for r in df.select(price_suffix("s", "p").alias("r")).collect()]
    assert got == ["x [Price: $12.35]", "y"]


def test_word_count_and_nulls(spark):
    assert one(spark, word_count(F.col("v")), "  a  b\tc ") == 3
    assert one(spark, word_count(F.col("v")), None) == 0


def test_keyword_points_real_lists(spark):
    h = "Recession fears and market volatility spark a stable recovery"
    # recession (3) + volatility (2) + stable (1) + recovery (1)
    assert one(spark, keyword_points(F.col("v"), STRESS_KEYWORDS), h) == 7.0
    assert one(spark, keyword_points(F.col("v"), STRESS_KEYWORDS), None) == 0.0


def test_price_stress_boundaries(spark):
    df = spark.createDataFrame([(2.0,), (2.01,), (-12.0,), (None,)], "c double")
    got = [r["r"] for r in df.select(price_stress("c").alias("r")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 1.005) < 1e-12 and got[2] == 5.0 and got[3] == 0.0


def test_mentions_with_type_override(spark):
    df = spark.createDataFrame([("Gold and oil rally", "index"), ("nothing here", "commodity")], "h string, t string")
    cols = mention_columns(F.col("h"), ASSET_CATEGORIES, "t")
    rows = df.select(*cols).collect()
    assert rows[0]["mentions_commodities"] == 1 and rows[0]["mentions_equities"] == 1
    assert rows[1]["mentions_commodities"] == 1 and rows[1]["mentions_forex"] == 0


def test_compound_rules(spark):
    df = spark.createDataFrame([("great gains",), ("not great",), ("very great",), ("great!!",), ("",), (None,)],
                               "h string")
    got = [r["c"] for r in df.select(compound(F.col("h"), SEED_LEXICON).alias("c")).collect()]
    import math
    s = 3.1 + 1.6
    assert abs(got[0] - round(s / math.sqrt(s * s + 15), 4)) < 1e-9
    s = 3.1 * -0.74
    assert abs(got[1] - round(s / math.sqrt(s * s + 15), 4)) < 1e-9
    s = 3.1 + 0.293
    assert abs(got[2] - round(s / math.sqrt(s * s + 15), 4)) < 1e-9
    s = 3.1 + 2 * 0.292
    assert abs(got[3] - round(s / math.sqrt(s * s + 15), 4)) < 1e-9
    assert got[4] == 0.0 and got[5] == 0.0


def test_polarity_subjectivity(spark):
    p, s = polarity_subjectivity(F.col("h"), SEED_LEXICON)
    r = spark.createDataFrame([("good and bad",), ("not good",), ("plain",)], "h string").select(
        p.alias("p"), s.alias("s")).collect()
    assert abs(r[0]["p"] - (0.7 - 0.7) / 2) < 1e-12 and abs(r[0]["s"] - (0.6 + 0.667) / 2) < 1e-12
    assert abs(r[1]["p"] - 0.7 * -0.5) < 1e-12
    assert r[2]["p"] == 0.0 and r[2]["s"] == 0.0


def test_java_whitespace_is_the_same_set(spark):
    from tidemark.functions.text import JAVA_WHITESPACE, WHITESPACE_CLASS, first_word_tag, words

    # every code point below 0x10000 as a character
    df = spark.createDataFrame([(chr(i),) for i in range(1, 65536) if not 0xD800 <= i < 0xE000], "c string")
    odd = df.where(F.col("c").rlike(f"^{WHITESPACE_CLASS}$") != F.col("c").rlike(f"^{JAVA_WHITESPACE}$"))
    assert odd.count() == 0
    assert df.where(F.col("c").rlike(f"^{JAVA_WHITESPACE}$")).count() == sum(chr(i).isspace() for i in range(65536))
    t = spark.createDataFrame([("　 a\x1fb",), ("",), (None,), (" \t",)], "v string")
    assert [r[0] for r in t.select(first_word_tag("v")).collect()] == [["a"], [], [], []]
    assert [r[0] for r in t.select(words("v")).collect()] == [["a", "b"], [], None, []]


def test_sentiment_sums_are_worked_out_once(spark):
    """The plan holds one sum of the scored tokens, and the values are those of the rules."""
    from tidemark.config import BINDING_LEXICON
    from tidemark.functions.sentiment import compound, scored_tokens

    df = spark.createDataFrame([(["very", "the", "not", "and"], "x!")], "t array<string>, h string")
    plan = df.select("h", scored_tokens(F.col("t"), BINDING_LEXICON).alias("s")).select(compound(F.col("h"), BINDING_LEXICON, F.col("s")))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.count("aggregate(s#") == 1
    v = [r.v for r in df.select(F.explode(scored_tokens(F.col("t"), BINDING_LEXICON)).alias("r")).select("r.*").collect()]
    assert [round(x, 6) for x in v] == [round(0.6 + 0.293, 6), round(1.1 * -0.74, 6)]
