"""Registered queries: one Spark job per operator, each with a DuckDB twin.

Every query reads the test tables through the fixture views, so its work
grows with the tables. Outputs are normalised for engine-to-engine
comparison: bytes become ints and doubles are rounded to 6 places (the SQL
twins round the same columns).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def normalise(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, raw: bool = False):
    """Decorator: register a Spark query and (optionally) its SQL twin.

    ``doubles`` names the double columns that the SQL twin must round.
    """

    def deco(fn):
        if raw:
            QUERIES[name] = fn
        else:
            QUERIES[name] = lambda spark, sf_dir: normalise(fn(spark, sf_dir))
        QUERIES[name].__name__ = name
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = round_sql(sql, doubles or [])
        return fn

    return deco


def round_sql(sql: str, doubles: list[str], digits: int = 6) -> str:
    """Wrap the final SELECT of ``sql`` so the named double columns are rounded."""
    if not doubles:
        return sql
    head, sep, body = sql.rpartition("\nSELECT ")
    if not sep:
        raise ValueError("round_sql expects a final '\\nSELECT ' statement")
    repl = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in doubles)
    return f"{head},\n__q AS (SELECT {body})\nSELECT * REPLACE ({repl}) FROM __q"
