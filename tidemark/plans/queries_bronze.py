"""Registered queries for quotes, bronze articles and page extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import r6
from tidemark.operators.quotes import (create_articles, derive_quotes, extraction_stats, filter_priority, market_stress,
                                       overview_articles)
from tidemark.plans import oracle as O
from tidemark.plans.registry import register
from tidemark.sources.pages import extract_all_methods, extract_quotes, page_elements
from tidemark.sources.tables import read_table
from tidemark.sources.views import instruments_binding, quotes

PRIORITY_FILTER = 2  # the shipped configuration's balanced setting

QUOTES_SQL = f"""
dv AS (
  SELECT CAST(ts AS DATE) AS day, event_type, value AS price FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) = 1),
dq AS (SELECT *, lag(price) OVER (PARTITION BY event_type ORDER BY day) AS prev_price FROM dv),
dim AS ({O.BINDING_INSTRUMENTS_SQL}),
quotes AS (
  SELECT strftime(day, '%Y-%m-%d') AS run_id, m.asset, m.asset_type, m.priority, dq.event_type AS symbol,
         strftime(day, '%Y-%m-%d') || 'T00:00:00' AS "timestamp", 'yahoo_finance' AS source,
         'events://' || dq.event_type AS url, price,
         coalesce(price - prev_price, 0.0) AS change,
         coalesce(100.0 * (price / prev_price - 1.0), 0.0) AS change_percent
  FROM dq JOIN dim m USING (event_type)),
dquotes AS (
  SELECT run_id, asset, asset_type, priority, symbol, "timestamp", source, url,
         {O.half_up_sql('price', 4)} AS price, {O.half_up_sql('change', 4)} AS change,
         {O.half_up_sql('change_percent', 4)} AS change_percent,
         {O.half_up_sql('CASE WHEN change <> 0 THEN price - change ELSE price END', 4)} AS prev_close
  FROM quotes WHERE coalesce(priority, 3) <= {PRIORITY_FILTER}),
factors AS (
  SELECT run_id,
         CASE WHEN contains(asset, 'VIX') THEN least(price / 10, 10.0) * 3.0 ELSE 0.0 END
           + least(abs(change_percent) / 2, 10.0) * (4 - coalesce(priority, 3))
           + CASE WHEN change_percent < -3 THEN least(abs(change_percent), 10.0) * 1.5 ELSE 0.0 END AS f,
         CASE WHEN contains(asset, 'VIX') THEN 1 ELSE 0 END + 1 + CASE WHEN change_percent < -3 THEN 1 ELSE 0 END AS n
  FROM dquotes),
stress AS (
  SELECT run_id, least({O.half_up_sql('sum(f) / sum(n)', 2)}, 10.0) AS market_stress_score,
         CAST(count(*) AS INTEGER) AS data_points
  FROM factors GROUP BY run_id)"""


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_quotes(filter_priority(quotes(spark, sf_dir), PRIORITY_FILTER))


@register("quotes_derived", f"""
WITH {QUOTES_SQL}
SELECT run_id, asset, asset_type, priority, round(price, 6) AS price, round(change, 6) AS change,
       round(change_percent, 6) AS change_percent, round(prev_close, 6) AS prev_close
FROM dquotes""")
def quotes_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ6 + PRJ9 over the daily quotes of every event type."""
    q = _quotes(spark, sf_dir)
    return q.select("run_id", "asset", "asset_type", "priority",
                    *[r6(F.col(c)).alias(c) for c in ("price", "change", "change_percent", "prev_close")])


@register("market_stress", f"""
WITH {QUOTES_SQL}
SELECT run_id, round(market_stress_score, 6) AS market_stress_score, data_points FROM stress""")
def market_stress_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3: stress score 0-10 per run."""
    s = market_stress(_quotes(spark, sf_dir))
    return s.select("run_id", r6(F.col("market_stress_score")).alias("market_stress_score"), "data_points")


def _line_sql() -> str:
    return (f"'  ' || CASE WHEN change_percent > 0 THEN 'UP' ELSE 'DOWN' END || ' ' || asset || ': $' || "
            f"{O.fmt_sql('price', 2)} || ' (' || {O.fmt_sql('change_percent', 2, True)} || '%)'")


BRONZE_SQL = f"""
WITH {QUOTES_SQL},
blocks AS (
  SELECT run_id, asset_type,
         upper(asset_type) || ':' || chr(10) ||
         string_agg(line, chr(10) ORDER BY -abs(change_percent), asset, line) || chr(10) AS block
  FROM (SELECT *, {_line_sql()} AS line FROM dquotes) GROUP BY run_id, asset_type),
runs AS (
  SELECT run_id, max("timestamp") AS ts, min(source) AS source, list_sort(list(asset)) AS tags
  FROM dquotes GROUP BY run_id),
bl AS (
  SELECT run_id, string_agg(block, chr(10) ORDER BY asset_type) AS body, list_sort(list(asset_type)) AS types
  FROM blocks GROUP BY run_id),
overview AS (
  SELECT r.run_id, 'overview' AS article_kind,
         'Market Overview - Stress Level ' || {O.fmt_sql('s.market_stress_score', 1)} || '/10' AS headline,
         'MARKET DATA' || chr(10) || 'Market Stress Score: ' || {O.fmt_sql('s.market_stress_score', 1)}
                   || '/10' || chr(10) || 'Data Points: ' || CAST(s.data_points AS VARCHAR) || chr(10)
                   || 'Source: ' || r.source || chr(10) || 'Timestamp: ' || r.ts || chr(10) || chr(10)
                   || b.body AS snippet,
         s.market_stress_score, s.data_points, array_to_string(b.types, '|') AS asset_types,
         array_to_string(r.tags, '|') AS asset_tags,
         CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS change, CAST(NULL AS DOUBLE) AS change_percent,
         CAST(NULL AS INTEGER) AS priority
  FROM runs r JOIN stress s USING (run_id) JOIN bl b USING (run_id)),
movers AS (
  SELECT run_id, 'mover' AS article_kind,
         asset || ' ' || dir || ' ' || {O.fmt_sql('abs(change_percent)', 1)} || '% to $' || {O.fmt_sql('price', 2)}
           AS headline,
         asset || ' (' || asset_type || ') is trading at $' || {O.fmt_sql('price', 2)} || ', '
           || substring(dir, 1, length(dir) - 1) || 'ing ' || {O.fmt_sql('abs(change_percent)', 2)}
           || '% from the previous close of $' || {O.fmt_sql('prev_close', 2)} || '. '
           || CASE WHEN coalesce(change, 0.0) <> 0 THEN 'Absolute change: $' || {O.fmt_sql('abs(change)', 2)} || '. '
                   ELSE '' END
           || CASE WHEN contains(asset, 'VIX') AND price > 30 THEN 'High volatility detected. '
                   WHEN contains(asset, 'VIX') AND price < 15 THEN 'Low volatility environment. ' ELSE '' END
           AS snippet,
         CAST(NULL AS DOUBLE) AS market_stress_score, CAST(NULL AS INTEGER) AS data_points,
         CAST(NULL AS VARCHAR) AS asset_types, asset AS asset_tags,
         price, change, change_percent, priority
  FROM (SELECT *, CASE WHEN change_percent > 3 THEN 'surges' WHEN change_percent > 0 THEN 'rises'
                       WHEN change_percent < -3 THEN 'plunges' ELSE 'falls' END AS dir FROM dquotes)
  WHERE abs(change_percent) > 2.0 OR (priority = 1 AND abs(change_percent) > 1.0) OR contains(asset, 'VIX'))
SELECT run_id, article_kind, headline, snippet, round(market_stress_score, 6) AS market_stress_score, data_points,
       asset_types, asset_tags, round(price, 6) AS price, round(change, 6) AS change,
       round(change_percent, 6) AS change_percent, priority
FROM (SELECT * FROM overview UNION ALL SELECT * FROM movers)"""


@register("bronze_articles", BRONZE_SQL)
def bronze_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3 + AGG4 + TOP5 + PRJ7 + PRJ8 + STR9 + SET2: overview and mover articles per run."""
    a = create_articles(filter_priority(quotes(spark, sf_dir), PRIORITY_FILTER))
    return a.select("run_id", "article_kind", "headline", "snippet",
                    r6(F.col("market_stress_score")).alias("market_stress_score"), "data_points",
                    F.array_join("asset_types", "|").alias("asset_types"),
                    F.array_join("asset_tags", "|").alias("asset_tags"),
                    *[r6(F.col(c)).alias(c) for c in ("price", "change", "change_percent")], "priority")


#: How a day's quote is written into its page: by day of the month.
PAGE_KINDS = ("element", "regex", "json", "meta")


def quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages, and one quote page per daily quote, in the four forms that the extraction chain reads."""
    q = derive_quotes(quotes(spark, sf_dir))
    price, change, pct = (F.format_string("%.4f", F.col(c)) for c in ("price", "change", "change_percent"))

    def streamer(name, value):
        return F.concat(F.lit('<fin-streamer class="x" data-symbol="'), F.col("symbol"), F.lit(f'" data-field="{name}"><span>'), value,
                        F.lit("</span></fin-streamer>"))

    raw = lambda name, value: F.concat(F.lit(f'"{name}":{{"raw":'), value, F.lit("}"))
    forms = [
        F.concat(streamer("regularMarketPrice", price), streamer("regularMarketChange", change),
                 streamer("regularMarketChangePercent", F.concat(pct, F.lit("%")))),
        F.concat(F.lit('<script>{"regularMarketPrice": '), price, F.lit(', "regularMarketChange": '), change,
                 F.lit(', "regularMarketChangePercent": '), pct, F.lit("}</script>")),
        F.concat(F.lit('<script>root.App.main = {"context":{"dispatcher":{"stores":{"QuoteSummaryStore":{"price":{'),
                 F.concat_ws(",", raw("regularMarketPrice", price), raw("regularMarketChange", change), raw("regularMarketChangePercent", pct)),
                 F.lit("}}}}}};</script>")),
        F.concat(F.lit('<meta property="og:price:amount" content="'), price, F.lit('">')),
    ]
    kind = F.dayofmonth(F.to_date("run_id")) % len(PAGE_KINDS)
    body = F.element_at(F.array(*forms), kind + 1)
    made = q.select(F.lit(None).cast("long").alias("page_id"),
                    F.concat(F.lit("https://quotes.example/quote/"), F.col("symbol"), F.lit("?day="), F.col("run_id")).alias("url"),
                    F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]).unionByName(made)


def _quote_dimension(spark: SparkSession) -> DataFrame:
    return instruments_binding(spark).withColumnRenamed("event_type", "symbol")


_MADE_SQL = f"""
WITH {QUOTES_SQL.replace(f"WHERE coalesce(priority, 3) <= {PRIORITY_FILTER}", "")}"""


@register("extraction_stats", f"""{_MADE_SQL},
n AS (SELECT (SELECT count(*) FROM pages) AS given, (SELECT count(*) FROM dquotes) AS made)
SELECT CAST(given + made AS BIGINT) AS total_requests, CAST(made AS BIGINT) AS successful, CAST(given AS BIGINT) AS failed,
       {O.fmt_sql('made * 100.0 / (given + made)', 1)} || '%' AS success_rate FROM n""")
def extraction_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3-SRC7 chain over every page, given ones (which hold no quotes) and quote pages, and AGG22 statistics."""
    return extraction_stats(extract_all_methods(quote_pages(spark, sf_dir), _quote_dimension(spark)))


@register("overview_stats", f"""{_MADE_SQL},
n AS (SELECT run_id, count(*) AS n FROM dquotes GROUP BY run_id)
SELECT run_id, 'Market Overview - Stress Level ' || {O.fmt_sql('s.market_stress_score', 1)} || '/10' AS headline,
       CAST(n AS BIGINT) AS total_requests, CAST(n AS BIGINT) AS successful, CAST(0 AS BIGINT) AS failed, '100.0%' AS success_rate
FROM stress s JOIN n USING (run_id)""")
def overview_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4 + AGG22: overview article of every run with the statistics of its extraction."""
    run = F.regexp_extract("url", "[?]day=(.*)$", 1)  # pages of no run form a group of their own
    stats = extraction_stats(extract_all_methods(quote_pages(spark, sf_dir), _quote_dimension(spark)).withColumn("run_id", run), "run_id")
    found = overview_articles(derive_quotes(quotes(spark, sf_dir)), stats=stats)
    return found.select("run_id", "headline", "scraper_stats.*")


@register("extract_quotes", f"""{_MADE_SQL}
SELECT 'https://quotes.example/quote/' || symbol || '?day=' || run_id AS url, symbol, asset, asset_type, priority,
       round(price, 4) AS price, CASE WHEN day(CAST(run_id AS DATE)) % 4 = 3 THEN 0.0 ELSE round(change, 4) END AS change,
       CASE WHEN day(CAST(run_id AS DATE)) % 4 = 3 THEN 0.0 ELSE round(change_percent, 4) END AS change_percent
FROM dquotes""")
def extract_quotes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3-SRC8 + J7: the quotes found on all pages, with their instrument."""
    found = extract_quotes(quote_pages(spark, sf_dir), _quote_dimension(spark))
    return found.select("url", "symbol", "asset", "asset_type", "priority", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("price", "change", "change_percent")])


@register("page_links", """
WITH e AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\b[^>]*>[^<]*</a>', 0)) AS el FROM pages)
SELECT page_id, regexp_extract(el, '\\bhref="([^"]*)"', 1) AS href, regexp_extract(el, '>([^<]*)<', 1) AS text
FROM e""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 element extraction with tag/attribute arguments: every link of every page."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    return page_elements(pages, "a", "href")
