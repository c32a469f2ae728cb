"""Registered queries: name -> (spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (or views Spark derives from
them) in full; result columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import oracle
from tidemark.plans.pipeline import daily_stress

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def positive_zero_rounding(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` as ``(round(x, 6) + 0.0)``: DuckDB keeps the sign of a rounded
    tiny negative (-0.0), Spark does not; adding +0.0 normalises it under IEEE rules."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounding(sql[j + 6:k])
        call = f"round({inner})"
        out.append(sql[i:j])
        out.append(f"({call} + 0.0)" if inner.replace(" ", "").endswith(",6") else call)
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = positive_zero_rounding(sql)
        return fn
    return deco


register("daily_stress", oracle.DAILY_STRESS)(daily_stress)

# further registrations live next to their query modules
from tidemark.plans import queries_silver  # noqa: E402,F401
from tidemark.plans import queries_bronze  # noqa: E402,F401
from tidemark.plans import queries_risk  # noqa: E402,F401
from tidemark.plans import queries_views  # noqa: E402,F401
from tidemark.plans import queries_models  # noqa: E402,F401
from tidemark.plans import queries_learning  # noqa: E402,F401
