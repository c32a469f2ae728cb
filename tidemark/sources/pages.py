"""Quote extraction from raw pages (SRC3-SRC8, J7): one map-only pass over a ``pages`` table.

Each method is a nullable struct (price, change, change_percent); the chain is a ``coalesce`` of the
structs in the reference's order, and a row is kept iff a price was found.  No HTML parser: the
markup patterns are regular expressions evaluated by the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import INSTRUMENTS
from tidemark.functions.text import WHITESPACE_CLASS

WS = WHITESPACE_CLASS + "*"
NUM = r"([0-9]+\.?[0-9]*)"
SNUM = r"(-?[0-9]+\.?[0-9]*)"


def instruments(spark: SparkSession) -> DataFrame:
    """SRC8: the instrument dimension (8 literal rows)."""
    return spark.createDataFrame(
        INSTRUMENTS, "asset string, symbol string, asset_type string, priority int, url string")


def elements(html: Column, tag: str) -> Column:
    """All ``<tag ...>...</tag>`` elements in page order, with whatever is nested in them up to their first
    end tag."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}\b[^>]*>.*?</{tag}\s*>"), 0)


def void_elements(html: Column, tag: str) -> Column:
    """All ``<tag ...>`` opening tags (e.g. ``meta``)."""
    return F.regexp_extract_all(html, F.lit(rf"<{tag}\b[^>]*>"), 0)


def attr(element: Column, name: str) -> Column:
    """Value of a double-quoted attribute ('' when absent)."""
    return F.regexp_extract(element, rf'(?<![\w-]){name}="([^"]*)"', 1)


def inner_text(element: Column) -> Column:
    """Full text of an element: its tags taken out, trimmed."""
    return F.trim(F.regexp_replace(element, r"<[^>]*>", ""))


def _num_if(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), (text).try_cast("double"))


def by_element(html: Column, symbol: Column) -> Column:
    """SRC3: ``<fin-streamer data-symbol=S data-field=F>`` text; the last element with a valid number wins."""
    els = elements(html, "fin-streamer")

    def field(name: str, strip: list[str], pattern: str) -> Column:
        hits = F.filter(els, lambda e: (attr(e, "data-symbol") == symbol) & (attr(e, "data-field") == name))

        def number(e: Column) -> Column:
            txt = inner_text(e)
            for ch in strip:
                txt = F.replace(txt, F.lit(ch), F.lit(""))
            return _num_if(txt, pattern)

        return F.try_element_at(F.filter(F.transform(hits, number), lambda x: x.isNotNull()), F.lit(-1))

    price = field("regularMarketPrice", [","], r"^[0-9.]+$")
    change = F.coalesce(field("regularMarketChange", [","], r"^[0-9.+-]+$"), F.lit(0.0))
    pct = F.coalesce(field("regularMarketChangePercent", ["%", ",", "+"], r"^[0-9.+-]+$"), F.lit(0.0))
    return F.when(price.isNotNull(), F.struct(price.alias("price"), change.alias("change"),
                                               pct.alias("change_percent")))


def _first(html: Column, key: str, num: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf'"{key}"[:{WHITESPACE_CLASS[1:-1]}]*{num}', 1), F.lit(""))


def by_regex(html: Column) -> Column:
    """SRC4: first ``"regularMarketPrice"`` (else ``"price"``) number on the page; change and change%
    likewise (default 0).  Not scoped to the symbol: the first match on the page wins."""
    price = F.coalesce(_first(html, "regularMarketPrice", NUM), _first(html, "price", NUM))
    change = F.coalesce(_first(html, "regularMarketChange", SNUM), _first(html, "change", SNUM))
    pct = F.coalesce(_first(html, "regularMarketChangePercent", SNUM), _first(html, "changePercent", SNUM))
    p = (price).try_cast("double")
    return F.when(p.isNotNull(), F.struct(
        p.alias("price"), F.coalesce((change).try_cast("double"), F.lit(0.0)).alias("change"),
        F.coalesce((pct).try_cast("double"), F.lit(0.0)).alias("change_percent")))


def by_json(html: Column) -> Column:
    """SRC5: the ``root.App.main = {...};`` blob, ``context.dispatcher.stores.QuoteSummaryStore.price``."""
    blob = F.regexp_extract(html, rf"(?s)root\.App\.main{WS}={WS}(\{{.*?\}}){WS};", 1)
    base = "$.context.dispatcher.stores.QuoteSummaryStore.price"
    has = F.get_json_object(blob, f"{base}.regularMarketPrice").isNotNull()

    def raw(name: str) -> Column:
        return F.coalesce((F.get_json_object(blob, f"{base}.{name}.raw")).try_cast("double"), F.lit(0.0))

    return F.when((blob != "") & has, F.struct(raw("regularMarketPrice").alias("price"),
                                               raw("regularMarketChange").alias("change"),
                                               raw("regularMarketChangePercent").alias("change_percent")))


def by_meta(html: Column) -> Column:
    """SRC6: ``<meta property="og:price:amount" content=X>``, change = change% = 0."""
    metas = F.filter(void_elements(html, "meta"), lambda e: attr(e, "property") == "og:price:amount")
    content = attr(F.element_at(metas, 1), "content")
    p = F.when(F.size(metas) > 0, (content).try_cast("double"))
    return F.when(p.isNotNull(), F.struct(p.alias("price"), F.lit(0.0).alias("change"),
                                          F.lit(0.0).alias("change_percent")))


def page_symbol(url: Column) -> Column:
    """Symbol of a quote-page URL (``.../quote/<symbol>``), URL-decoded."""
    raw = F.regexp_extract(url, r"/quote/([^/?#]+)", 1)
    return F.when(raw != "", F.try_url_decode(raw) if hasattr(F, "try_url_decode") else F.url_decode(raw))


def extract_all_methods(pages: DataFrame, dim: DataFrame) -> DataFrame:
    """J7 + SRC3-SRC7 before the price filter: one row per page with the chained result."""
    p = pages.select("page_id", "url", "html", page_symbol(F.col("url")).alias("_sym"))
    # no hint: Spark broadcasts a dimension that its size shows to be small
    dim = dim.select("symbol", "asset", "asset_type", "priority")
    j = p.join(dim, p["_sym"] == dim["symbol"], "left")
    html = F.col("html")
    chosen = F.coalesce(by_element(html, F.coalesce(F.col("symbol"), F.col("_sym"))), by_regex(html),
                        by_json(html), by_meta(html))
    return j.select("page_id", "url", F.coalesce("symbol", "_sym").alias("symbol"), "asset", "asset_type",
                    "priority", chosen.alias("q")).select(
        "page_id", "url", "symbol", "asset", "asset_type", "priority",
        F.col("q.price").alias("price"), F.col("q.change").alias("change"),
        F.col("q.change_percent").alias("change_percent"))


def extract_quotes(pages: DataFrame, dim: DataFrame) -> DataFrame:
    """SRC7: rows whose chain found a price."""
    return extract_all_methods(pages, dim).where(F.col("price").isNotNull())


def page_elements(pages: DataFrame, tag: str, attribute: str) -> DataFrame:
    """The element machinery of SRC3 with other arguments: (page_id, attribute value, text) for
    every ``<tag attribute=...>text</tag>`` of every page."""
    e = pages.select("page_id", F.explode(elements(F.col("html"), tag)).alias("_e"))
    return e.select("page_id", attr(F.col("_e"), attribute).alias(attribute),
                    inner_text(F.col("_e")).alias("text"))
