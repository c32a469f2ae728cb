"""Quotes and pages: FIXTURES F1 (stress score, directions) and F7 (the four extraction methods)."""

from pyspark.sql import functions as F

from tidemark.operators.quotes import create_articles, derive_quotes, direction, market_stress
from tidemark.sources.pages import extract_all_methods, instruments

Q = "run_id string, asset string, asset_type string, priority int, symbol string, timestamp string, " \
    "source string, url string, price double, change double, change_percent double"


def quotes(spark, rows):
    return spark.createDataFrame(rows, Q)


def test_stress_score_hand_values(spark):
    rows = [("r", "VIX", "volatility", 1, "^VIX", "t", "s", "u", 35.0, 2.0, 6.0),
            ("r", "Gold", "commodity", 1, "GC=F", "t", "s", "u", 2000.0, -80.0, -4.0),
            ("r", "Silver", "commodity", 2, "SI=F", "t", "s", "u", 20.0, 0.1, 0.5)]
    s = market_stress(quotes(spark, rows)).first()
    assert s["market_stress_score"] == 6.4 and s["data_points"] == 3


def test_stress_score_cap(spark):
    rows = [("r", "VIX", "volatility", 1, "^VIX", "t", "s", "u", 500.0, 0.0, 40.0)]
    assert market_stress(quotes(spark, rows)).first()["market_stress_score"] == 10.0


def test_direction_boundaries(spark):
    df = spark.createDataFrame([(3.0,), (3.01,), (-3.0,), (-3.01,), (0.0,)], "c double")
    got = [r["d"] for r in df.select(direction(F.col("c")).alias("d")).collect()]
    assert got == ["rises", "surges", "falls", "plunges", "falls"]


def test_articles_overview_and_movers(spark):
    rows = [("r", "VIX", "volatility", 1, "^VIX", "t", "s", "u", 35.0, 2.0, 6.0),
            ("r", "Silver", "commodity", 2, "SI=F", "t", "s", "u", 20.0, 0.1, 0.5)]
    a = create_articles(quotes(spark, rows)).orderBy("article_kind").collect()
    assert [r["article_kind"] for r in a] == ["mover", "overview"]
    mover = a[0]
    assert mover["headline"] == "VIX surges 6.0% to $35.00"
    assert mover["snippet"].startswith("VIX (volatility) is trading at $35.00, surgeing 6.00% from the previous")
    assert "High volatility detected." in mover["snippet"]
    ov = a[1]
    assert ov["headline"] == "Market Overview - Stress Level 6.5/10" or ov["headline"].startswith("Market Overview")
    assert ov["asset_types"] == ["commodity", "volatility"]
    assert "  UP VIX: $35.00 (+6.00%)" in ov["snippet"]


def test_prev_close(spark):
    rows = [("r", "A", "index", 1, "A", "t", "s", "u", 10.0, 0.0, 0.0),
            ("r", "B", "index", 1, "B", "t", "s", "u", 10.0, 1.5, 17.6470588)]
    got = {r["asset"]: r["prev_close"] for r in derive_quotes(quotes(spark, rows)).collect()}
    assert got == {"A": 10.0, "B": 8.5}


PAGES = [
    (1, "https://finance.yahoo.com/quote/%5EGSPC",
     '<fin-streamer data-symbol="^GSPC" data-field="regularMarketPrice">5,123.45</fin-streamer>'
     '<fin-streamer data-field="regularMarketChangePercent" data-symbol="^GSPC">+1.2%</fin-streamer>'),
    (2, "https://finance.yahoo.com/quote/%5EDJI", '<script>{"regularMarketPrice": 12.5, "change": -0.3}</script>'),
    (3, "https://finance.yahoo.com/quote/%5EIXIC",
     '<script>root.App.main = {"context":{"dispatcher":{"stores":{"QuoteSummaryStore":{"price":'
     '{"regularMarketPrice":{"raw":99.5},"regularMarketChange":{"raw":1.5}}}}}}};</script>'),
    (4, "https://finance.yahoo.com/quote/GC=F", '<meta content="2010.5" property="og:price:amount">'),
    (5, "https://finance.yahoo.com/quote/SI=F", "<html><body>nothing</body></html>"),
]


def test_extraction_chain(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in extract_all_methods(pages, instruments(spark)).collect()}
    assert got[1]["price"] == 5123.45 and got[1]["change"] == 0.0 and got[1]["change_percent"] == 1.2
    assert got[1]["asset"] == "S&P 500"
    assert got[2]["price"] == 12.5 and got[2]["change"] == -0.3
    assert got[3]["price"] == 99.5 and got[3]["change"] == 1.5 and got[3]["change_percent"] == 0.0
    assert got[4]["price"] == 2010.5 and got[4]["change"] == 0.0
    assert got[5]["price"] is None
