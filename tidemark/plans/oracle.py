"""DuckDB SQL for the correctness gate: one independent statement per registered query.

The pieces (CTEs) mirror the views and operators; they are written in plain SQL over the driver
tables, so the Spark plans are checked against a second engine, not against themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tidemark.config import (BINDING_CATEGORIES, BINDING_INSTRUMENTS, BINDING_KEYWORDS, BINDING_LEXICON,
                             TIER_POINTS, WEIGHTS, Lexicon)
from tidemark.functions.text import DISALLOWED_CHARS, PUNCT_RUN, TOKEN_SPLIT, WHITESPACE_CLASS

BINDING_TYPE_TO_CATEGORY = {"click": "commodities", "error": "volatility"}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(col: str) -> str:
    s = f"regexp_replace({col}, {q(WHITESPACE_CLASS + '+')}, ' ', 'g')"
    s = f"regexp_replace({s}, {q(DISALLOWED_CHARS)}, '', 'g')"
    s = f"regexp_replace({s}, {q(PUNCT_RUN)}, '\\1', 'g')"
    return f"CASE WHEN {col} IS NULL THEN '' ELSE trim({s}) END"


def half_up_sql(col: str, digits: int) -> str:
    """Spark's ``round``: half-up on the shortest decimal form of the double."""
    return f"(CAST(round(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE) + 0.0)"


def fmt_sql(col: str, digits: int, signed: bool = False) -> str:
    return f"printf('%{'+' if signed else ''}.{digits}f', {half_up_sql(col, digits)})"


def tokens_sql(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), {q(TOKEN_SPLIT)}), lambda x: x <> '')"


def words_sql(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, {q(WHITESPACE_CLASS + '+')}), lambda x: x <> '')"


def keyword_sql(col: str, tiers: Mapping[str, Sequence[str]]) -> str:
    terms = []
    for tier, words in tiers.items():
        for kw in dict.fromkeys(words):
            terms.append(f"CASE WHEN contains(lower({col}), {q(kw.lower())}) THEN {TIER_POINTS[tier]} ELSE 0 END")
    return "CAST((" + " + ".join(terms or ["0"]) + f") AS DOUBLE)"


def mentions_sql(col: str, categories: Mapping[str, Sequence[str]], type_col: str | None,
                 type_to_category: Mapping[str, str]) -> list[str]:
    out = []
    for cat, words in categories.items():
        cond = " OR ".join(f"contains(lower({col}), {q(w.lower())})" for w in dict.fromkeys(words))
        types = [t for t, c in type_to_category.items() if c == cat]
        pre = f"WHEN {type_col} IN ({', '.join(q(t) for t in types)}) THEN 1 " if (types and type_col) else ""
        out.append(f"CAST(CASE {pre}WHEN {col} IS NOT NULL AND ({cond}) THEN 1 ELSE 0 END AS INTEGER) "
                   f"AS mentions_{cat}")
    return out


def values_sql(d: Mapping[str, float]) -> str:
    if not d:
        return "SELECT CAST(NULL AS VARCHAR) AS tok, CAST(NULL AS DOUBLE) AS val WHERE false"
    rows = ", ".join(f"({q(k)}, CAST({float(v)!r} AS DOUBLE))" for k, v in sorted(d.items()))
    return f"SELECT * FROM (VALUES {rows}) AS t(tok, val)"


def in_list(col: str, words: Sequence[str]) -> str:
    if not words:
        return "false"
    return f"coalesce({col} IN ({', '.join(q(w) for w in words)}), false)"


# ------------------------------------------------------------------------------------------ views

ARTICLES = """
ev AS (
  SELECT event_id, ts, event_type, value,
         lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS prev_value
  FROM events),
articles AS (
  SELECT d.doc_id AS row_id, d.text AS headline, date_trunc('hour', e.ts) AS "timestamp",
         d.source AS source, e.event_type AS asset_type, e.value AS price,
         5.0 * (e.value / e.prev_value - 1.0) AS change_percent
  FROM documents d LEFT JOIN ev e
    ON e.event_id = (d.doc_id * 10) % (SELECT max(event_id) + 1 FROM events))"""

MARKET_SILVER = f"""
mvalid AS (
  SELECT * FROM articles WHERE headline IS NOT NULL AND headline <> '' AND "timestamp" IS NOT NULL),
mclean AS (
  SELECT row_id, {clean_sql('headline')} AS headline, "timestamp", source, asset_type, price, change_percent
  FROM mvalid),
menr AS (
  SELECT *,
         CASE WHEN price IS NULL THEN headline ELSE headline || ' [Price: $' || {fmt_sql('price', 2)} || ']' END
           AS snippet,
         CASE WHEN len({words_sql('headline')}) > 0 THEN [{words_sql('headline')}[1]] ELSE [] END AS asset_tags,
         CASE WHEN asset_type IS NULL THEN [] ELSE [asset_type] END AS market_tags
  FROM mclean),
msilver AS (
  SELECT * FROM menr QUALIFY row_number() OVER (PARTITION BY headline, "timestamp" ORDER BY row_id) = 1)"""


def text_features_cte(src: str, lex: Lexicon = BINDING_LEXICON,
                      keywords: Mapping[str, Sequence[str]] = BINDING_KEYWORDS,
                      categories: Mapping[str, Sequence[str]] = BINDING_CATEGORIES,
                      type_to_category: Mapping[str, str] = BINDING_TYPE_TO_CATEGORY,
                      has_change: bool = True, has_type: bool = True) -> str:
    negs = list(lex.negations)
    combined = ("CASE WHEN change_percent IS NULL THEN vader_compound ELSE (vader_compound + "
                "greatest(least(change_percent, 10.0), -10.0) / 10.0) / 2.0 END") if has_change else "vader_compound"
    pstress = (" + CASE WHEN abs(change_percent) > 2 THEN least(abs(change_percent) / 2.0, 5.0) ELSE 0.0 END"
               if has_change else "")
    mentions = ",\n         ".join(mentions_sql("headline", categories, "asset_type" if has_type else None,
                                                 type_to_category))
    return f"""
lex_val AS ({values_sql(lex.valence)}),
lex_boost AS ({values_sql(lex.boosters)}),
lex_pol AS ({values_sql(lex.polarity)}),
lex_subj AS ({values_sql(lex.subjectivity)}),
tok_lists AS (SELECT row_id, {tokens_sql('headline')} AS t FROM {src}),
toks AS (SELECT row_id, unnest(t) AS tok, unnest(range(len(t))) AS pos FROM tok_lists),
tok_ctx AS (
  SELECT row_id, pos, tok,
         lag(tok, 1) OVER w AS p1, lag(tok, 2) OVER w AS p2, lag(tok, 3) OVER w AS p3
  FROM toks WINDOW w AS (PARTITION BY row_id ORDER BY pos)),
tok_scored AS (
  SELECT c.row_id,
         coalesce(v.val, 0.0) AS v0, coalesce(b.val, 0.0) AS b,
         {in_list('c.p1', negs)} OR {in_list('c.p2', negs)} OR {in_list('c.p3', negs)} AS negated,
         pl.val * CASE WHEN {in_list('c.p1', negs)} THEN -0.5 ELSE 1.0 END AS pol,
         sj.val AS subj
  FROM tok_ctx c
  LEFT JOIN lex_val v ON v.tok = c.tok
  LEFT JOIN lex_boost b ON b.tok = c.p1
  LEFT JOIN lex_pol pl ON pl.tok = c.tok
  LEFT JOIN lex_subj sj ON sj.tok = c.tok),
tok_agg AS (
  SELECT row_id,
         sum(CASE WHEN negated THEN v1 * -0.74 ELSE v1 END) AS s,
         avg(pol) AS pol, avg(subj) AS subj
  FROM (SELECT *, CASE WHEN v0 <> 0 THEN v0 + sign(v0) * b * 0.293 ELSE v0 END AS v1 FROM tok_scored)
  GROUP BY row_id),
sent AS (
  SELECT x.*, coalesce(a.pol, 0.0) AS sentiment_polarity, coalesce(a.subj, 0.0) AS sentiment_subjectivity,
         coalesce(a.s, 0.0) AS s0,
         least(length(x.headline) - length(replace(x.headline, '!', '')), 4) AS bangs
  FROM {src} x LEFT JOIN tok_agg a USING (row_id)),
sent2 AS (
  SELECT *, CASE WHEN s0 <> 0 THEN s0 + sign(s0) * bangs * 0.292 ELSE s0 END AS s1 FROM sent),
textf AS (
  SELECT * EXCLUDE (s0, s1, bangs),
         {half_up_sql('s1 / sqrt(s1 * s1 + 15.0)', 4)} AS vader_compound
  FROM sent2),
textf2 AS (
  SELECT *, {combined} AS combined_sentiment,
         {keyword_sql('headline', keywords)}{pstress} AS keyword_stress_score,
         CAST(length(headline) AS INTEGER) AS headline_length,
         CAST(len({words_sql('headline')}) AS INTEGER) AS word_count,
         {mentions}
  FROM textf)"""


def temporal_cte(src: str) -> str:
    return f"""
day_counts AS (SELECT CAST("timestamp" AS DATE) AS date, count(*) AS cnt FROM {src} GROUP BY 1),
spine AS (
  SELECT CAST(unnest(generate_series(min(CAST("timestamp" AS DATE)), max(CAST("timestamp" AS DATE)),
                                     INTERVAL 1 DAY)) AS DATE) AS date
  FROM {src}),
daily AS (
  SELECT s.date, CAST(coalesce(c.cnt, 0) AS BIGINT) AS daily_article_count FROM spine s
  LEFT JOIN day_counts c USING (date)),
daily_f AS (
  SELECT date, daily_article_count,
         avg(CAST(daily_article_count AS DOUBLE)) OVER w7 AS rolling_7d_mean,
         coalesce(stddev_samp(CAST(daily_article_count AS DOUBLE)) OVER w7, 0.0) AS rolling_7d_volatility,
         CAST(coalesce(lag(daily_article_count, 1) OVER w, 0) AS BIGINT) AS lag_1d,
         CAST(coalesce(lag(daily_article_count, 3) OVER w, 0) AS BIGINT) AS lag_3d,
         CAST(coalesce(lag(daily_article_count, 7) OVER w, 0) AS BIGINT) AS lag_7d
  FROM daily WINDOW w AS (ORDER BY date), w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
temporal AS (
  SELECT x.*, CAST(hour(x."timestamp") AS INTEGER) AS hour,
         CAST(isodow(x."timestamp") - 1 AS INTEGER) AS day_of_week,
         CAST(CASE WHEN isodow(x."timestamp") >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         CAST(month(x."timestamp") AS INTEGER) AS month,
         d.* EXCLUDE (date)
  FROM {src} x LEFT JOIN daily_f d ON d.date = CAST(x."timestamp" AS DATE)
  WHERE x."timestamp" IS NOT NULL)"""


def _z(col: str) -> str:
    return (f"CASE WHEN st.sd_{col} IS NULL OR st.sd_{col} = 0 THEN 0.0 "
            f"ELSE (t.{col} - st.m_{col}) / st.sd_{col} END")


def composite_cte(src: str, categories: Mapping[str, Sequence[str]] = BINDING_CATEGORIES,
                  weights: Mapping[str, float] = WEIGHTS) -> str:
    cols = ("sentiment_polarity", "keyword_stress_score", "combined_sentiment", "daily_article_count")
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS sd_{c}" for c in cols)
    breadth = " + ".join(f"coalesce(t.mentions_{c}, 0)" for c in categories)
    rec = ("greatest(least(1.0 - (epoch_us(st.max_ts) / 86400e6 - epoch_us(t.\"timestamp\") / 86400e6) / "
           "CASE WHEN epoch_us(st.max_ts) / 86400e6 - epoch_us(st.min_ts) / 86400e6 > 0 "
           "THEN epoch_us(st.max_ts) / 86400e6 - epoch_us(st.min_ts) / 86400e6 ELSE 1.0 END, 1.0), 0.0)")
    return f"""
gstats AS (SELECT {stats}, min("timestamp") AS min_ts, max("timestamp") AS max_ts, count(*) AS n FROM {src}),
scored AS (
  SELECT t.*,
         0.0 + {weights['sentiment']!r} * ({_z('combined_sentiment')})
             + {weights['keyword_stress']!r} * ({_z('keyword_stress_score')})
             + {weights['volume']!r} * ({_z('daily_article_count')})
             + {weights['recency']!r} * ({rec}) AS weighted_stress_score,
         CAST({breadth} AS INTEGER) AS market_breadth,
         st.n AS n_rows
  FROM {src} t CROSS JOIN gstats st),
gold AS (
  SELECT * EXCLUDE (n_rows),
         CASE WHEN n_rows >= 7 THEN coalesce(stddev_samp(sentiment_polarity) OVER
              (ORDER BY "timestamp", row_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0.0) ELSE 0.0 END
           AS sentiment_volatility_7d,
         coalesce(lead(weighted_stress_score) OVER (ORDER BY "timestamp", row_id), weighted_stress_score)
           AS target_stress_next
  FROM scored)"""


def gold_ctes() -> str:
    """Gold rows over whole texts: the market rules keep every text."""
    return ",".join([ARTICLES, MARKET_SILVER, text_features_cte("msilver"), temporal_cte("textf2"),
                     composite_cte("temporal")])


DAILY_STRESS = f"""
WITH {gold_ctes()}
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS date,
       CAST(count(*) AS BIGINT) AS n_articles,
       CAST(max(daily_article_count) AS BIGINT) AS daily_article_count,
       round(max(rolling_7d_mean), 6) AS rolling_7d_mean,
       round(max(rolling_7d_volatility), 6) AS rolling_7d_volatility,
       CAST(max(lag_1d) AS BIGINT) AS lag_1d,
       CAST(max(lag_3d) AS BIGINT) AS lag_3d,
       CAST(max(lag_7d) AS BIGINT) AS lag_7d,
       round(avg(weighted_stress_score), 6) AS mean_stress,
       round(max(weighted_stress_score), 6) AS max_stress,
       round(avg(keyword_stress_score), 6) AS mean_keyword_stress,
       round(avg(vader_compound), 6) AS mean_compound,
       round(avg(sentiment_polarity), 6) AS mean_polarity,
       round(avg(target_stress_next), 6) AS mean_target_next,
       round(avg(sentiment_volatility_7d), 6) AS mean_sentiment_vol,
       CAST(sum(market_breadth) AS BIGINT) AS sum_breadth
FROM gold GROUP BY 1
"""

BINDING_INSTRUMENTS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({q(e)}, {q(a)}, {q(t)}, {p})" for e, a, t, p in BINDING_INSTRUMENTS) + \
    ") AS t(event_type, asset, asset_type, priority)"
