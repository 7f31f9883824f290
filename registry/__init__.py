"""Registered queries: each pairs a Spark plan over the given tables with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .inputs import Inputs

Plan = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as UTC wall time, the types the oracle returns."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``; ``sql`` is its DuckDB equivalent."""

    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(plan(Inputs(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def load_all() -> None:
    from . import aggregates, checks, documents, files, filters, loads, marts, relational, reports, scalars  # noqa: F401
