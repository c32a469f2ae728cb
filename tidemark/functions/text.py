"""Text column expressions (STR1, STR5, STR8, STR9, ARR1, ARR2).

All regexes spell out their character classes so that Java regex (Spark) and RE2 (the SQL oracle)
agree with Python's Unicode ``\\s`` / ``\\w``: whitespace is the ``str.isspace`` set and a word
character is ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the characters Python's str.isspace() accepts, and the cleaning patterns.
WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set in Java's terms: one property test a character, in place of a chain of single ones.
JAVA_WHITESPACE = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"
JAVA_WORD = r"[^\p{IsWhite_Space}\x{1C}-\x{1F}]+"
DISALLOWED_CHARS = r"[^\p{L}\p{N}_ .,!?$%€£¥+\-]"
PUNCT_RUN = r"([.,!?]){2,}"
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """STR1: NULL -> ''; whitespace runs -> one space; drop all but word chars, space and
    ``.,!?$%€£¥+-``; a run of ``.,!?`` collapses to its last char; trim."""
    c = _c(c)
    s = F.regexp_replace(c, JAVA_WHITESPACE + "+", " ")
    s = F.regexp_replace(s, DISALLOWED_CHARS, "")
    s = F.regexp_replace(s, PUNCT_RUN, "$1")
    return F.when(c.isNull(), F.lit("")).otherwise(F.trim(s))


def words(c: str | Column) -> Column:
    """Python ``str.split()``: whitespace-separated, non-empty pieces."""
    return F.filter(F.split(_c(c), JAVA_WHITESPACE + "+"), lambda x: x != F.lit(""))


def headline_length(c: str | Column) -> Column:
    """STR5 length in characters (code points); NULL -> 0."""
    return F.coalesce(F.length(_c(c)), F.lit(0)).cast("int")


def word_count(c: str | Column) -> Column:
    """STR5 number of whitespace-separated words; NULL -> 0."""
    return F.coalesce(F.size(words(c)), F.lit(0)).cast("int")


def tokens(c: str | Column, low: Column | None = None) -> Column:
    """Lower-cased word tokens (letters, digits, underscore) used by the lexicon scorers; ``low``: the lower-cased text,
    where it is at hand."""
    return F.filter(F.split(F.lower(_c(c)) if low is None else low, TOKEN_SPLIT), lambda x: x != F.lit(""))


def price_suffix(snippet: str | Column, price: str | Column) -> Column:
    """STR8: `` [Price: $x.xx]`` appended; a NULL price leaves the snippet unchanged (D28)."""
    snippet, price = _c(snippet), _c(price)
    return F.when(price.isNull(), snippet).otherwise(
        F.concat(snippet, F.lit(" [Price: $"), fmt_fixed(price, 2), F.lit("]")))


def _pre_round(c: Column, digits: int) -> Column:
    # round first (HALF_UP on the shortest decimal form), so the formatter never meets a tie;
    # + 0.0 prints a rounded -0.0 as 0.0
    return F.round(c, digits) + F.lit(0.0)


def fmt_signed(c: str | Column, digits: int = 2) -> Column:
    """STR9 ``+.2f`` formatting (exact decimal ties round half-up)."""
    return F.format_string(f"%+.{digits}f", _pre_round(_c(c), digits))


def fmt_fixed(c: str | Column, digits: int = 2) -> Column:
    """STR9 ``.2f`` / ``.1f`` formatting (exact decimal ties round half-up)."""
    return F.format_string(f"%.{digits}f", _pre_round(_c(c), digits))


def single_tag(c: str | Column) -> Column:
    """ARR1: ``[x]`` when x is not NULL, else ``[]``."""
    c = _c(c)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c))


def first_word_tag(c: str | Column) -> Column:
    """ARR1 fallback: first word of the headline, ``[]`` for NULL/blank.  The rest of the text is not split."""
    w = F.regexp_extract(_c(c), JAVA_WORD, 0)
    return F.when(w != "", F.array(w)).otherwise(F.array().cast("array<string>"))


def parse_list(c: str | Column) -> Column:
    """ARR2 for a string column: ``'[...]'`` -> parsed list (single quotes accepted), unparsable
    bracket text -> ``[text]``, other non-empty text -> ``[text]``, ''/NULL -> ``[]``.  Arrays are
    kept as they are (D3); no ``eval`` (D4)."""
    c = _c(c)
    parsed = F.from_json(c, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    empty = F.array().cast("array<string>")
    return (F.when(c.isNull() | (c == ""), empty)
            .when(c.startswith("["), F.coalesce(parsed, F.array(c)))
            .otherwise(F.array(c)))
