"""Lexicon sentiment (STR2, STR3) as array higher-order functions: no Python UDF.

The reference calls two downloaded lexicon libraries.  Here the lexicon is data (``Lexicon``) and
the rules are the published rule-based ones, restricted to what is stated below:

compound (STR2)
    tokens = lower-cased word tokens; v_i = valence(token_i) (0 if absent);
    a booster word right before a scored token adds ``sign(v_i) * booster * 0.293``;
    a negation among the three preceding tokens multiplies v_i by -0.74;
    s = sum(v_i); if s != 0 it moves away from 0 by ``min(#'!', 4) * 0.292``;
    compound = s / sqrt(s^2 + 15), rounded to 4 digits; NULL text -> 0.

polarity / subjectivity (STR3)
    mean over tokens found in the polarity table of polarity (times -0.5 when the previous token
    is a negation), mean subjectivity over tokens found in the subjectivity table; 0 when none.

Tokens that no table of the lexicon holds are filtered out first (a hash-set test per token); the
rest become structs of their values in one pass, and every score is one aggregate over that short list.
The tables are plan constants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import (VADER_ALPHA, VADER_BOOSTER_INCREMENT, VADER_EXCLAMATION_INCREMENT,
                             VADER_MAX_EXCLAMATIONS, VADER_NEGATION_SCALAR, Lexicon)
from tidemark.functions.text import tokens


def _map(d: dict[str, float]) -> Column:
    if not d:
        return F.create_map().cast("map<string,double>")
    keys = sorted(d)
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                             F.array(*[F.lit(float(d[k])) for k in keys]))


def scored_tokens(toks: Column, lex: Lexicon) -> Column:
    """array<struct<v, pol, subj>> of the tokens with a value: valence after booster and negation (0 if
    the token has none), polarity and subjectivity (null if none).

    ``toks`` should be a column *reference* to precomputed ``tokens(text)``: an inline expression would
    be evaluated again for every element access inside the lambdas."""
    known = sorted({*lex.valence, *lex.polarity, *lex.subjectivity})
    if not known:
        return F.array().cast("array<struct<v:double,pol:double,subj:double>>")
    entries = F.map_from_arrays(F.array(*[F.lit(k) for k in known]), F.array(*[F.struct(
        *[F.lit(table.get(k)).cast("double").alias(name) for name, table in (
            ("v", lex.valence), ("pol", lex.polarity), ("subj", lex.subjectivity))]) for k in known]))
    boost = _map(lex.boosters)

    def is_negation(i: Column) -> Column:
        return F.coalesce(F.get(toks, i).isin(sorted(lex.negations)), F.lit(False)) if lex.negations else F.lit(False)

    def values(x: Column) -> Column:
        i, own = x["i"], x["own"]
        v = F.coalesce(own["v"], F.lit(0.0))
        b = F.coalesce(F.try_element_at(boost, F.get(toks, i - 1)), F.lit(0.0))
        negated = is_negation(i - 1) | is_negation(i - 2) | is_negation(i - 3)
        scale = F.when(negated, F.lit(VADER_NEGATION_SCALAR)).otherwise(F.lit(1.0))
        return F.struct(
            F.when(v != 0, (v + F.signum(v) * b * F.lit(VADER_BOOSTER_INCREMENT)) * scale).otherwise(F.lit(0.0)).alias("v"),
            (own["pol"] * F.when(is_negation(i - 1), F.lit(-0.5)).otherwise(F.lit(1.0))).alias("pol"),
            own["subj"].alias("subj"))

    places = F.when(F.size(toks) > 0, F.sequence(F.lit(0), F.size(toks) - 1)).otherwise(F.array().cast("array<int>"))
    found = F.filter(places, lambda i: F.get(toks, i).isin(known))
    # a token is looked up once, for all its values
    return F.transform(F.transform(found, lambda i: F.struct(i.alias("i"), F.try_element_at(entries, F.get(toks, i)).alias("own"))), values)


def compound(text: Column, lex: Lexicon, scored: Column | None = None) -> Column:
    scored = scored_tokens(tokens(text), lex) if scored is None else scored
    s = F.aggregate(scored, F.lit(0.0), lambda acc, x: acc + x["v"])
    bangs = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
                    F.lit(VADER_MAX_EXCLAMATIONS))
    # one-element arrays hold the sum and what the marks make of it, so that neither is worked out again where it is named
    s = F.transform(F.array(s), lambda s: F.when(s != 0, s + F.signum(s) * bangs * F.lit(VADER_EXCLAMATION_INCREMENT)).otherwise(s))
    comp = F.get(F.transform(s, lambda s: F.round(s / F.sqrt(s * s + F.lit(VADER_ALPHA)), 4)), 0)
    return F.when(text.isNull(), F.lit(0.0)).otherwise(comp)


def polarity_subjectivity(text: Column, lex: Lexicon, scored: Column | None = None) -> tuple[Column, Column]:
    scored = scored_tokens(tokens(text), lex) if scored is None else scored

    def mean(name: str) -> Column:
        zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
        return F.aggregate(
            scored, zero,
            lambda acc, x: F.struct((acc["s"] + F.coalesce(x[name], F.lit(0.0))).alias("s"),
                                    (acc["n"] + F.when(x[name].isNull(), 0).otherwise(1)).alias("n")),
            lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]).otherwise(F.lit(0.0)))

    p = F.when(text.isNull(), F.lit(0.0)).otherwise(mean("pol"))
    s = F.when(text.isNull(), F.lit(0.0)).otherwise(mean("subj"))
    return p, s
