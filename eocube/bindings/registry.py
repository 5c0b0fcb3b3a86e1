"""Registry of queries and the views over the tables they start from."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.bindings.fixtures import SPARK_VIEWS, VIEWS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """Tables and views of one data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in SPARK_VIEWS:
            return SPARK_VIEWS[name](self)
        if name in VIEWS:
            text = VIEWS[name]
            used = {t: getattr(self, t) for t in set(re.findall(r"\{([a-z]\w*)\}", text))}
            return self.spark.sql(text, **used)
        raise AttributeError(name)


def _with_views(body: str) -> str:
    """Prepend the views a statement uses, each before its users."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bfx_(\w+)", text))):
            if name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(body)
    views = ",\n".join(f"fx_{n} as ({_plain(VIEWS[n])})" for n in order)
    body = _plain(body).strip()
    if not views:
        return body
    if body.lower().startswith("with "):
        return f"with {views},\n{body[5:]}"
    return f"with {views}\n{body}"


def _plain(text: str) -> str:
    return re.sub(r"\{([a-z]\w*)\}", r"\1", text)


def query(key: str, sql: str | None = None):
    """Register a function of :class:`Tables` and the SQL that checks it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in _QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        _QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _ORACLES[key] = _with_views(sql)
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def r6(c: Column | str, name: str | None = None, digits: int = 6) -> Column:
    """Round to six digits (fewer for large magnitudes), without a negative zero."""
    if isinstance(c, str):
        name, c = name or c, F.col(c)
    out = F.round(c.cast("double"), digits) + F.lit(0.0)
    return out.alias(name) if name else out


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r6(F.col(c), digits=digits) for c in columns})


def q6(expr: str, digits: int = 6) -> str:
    """The SQL twin of :func:`r6`."""
    return f"(round(cast({expr} as double), {digits}) + 0e0)"


def i64(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})
