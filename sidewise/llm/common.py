"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from sidewise.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows and bytes that one Arrow batch may hold, so that a worker's memory does not follow the table.
BATCH_ROWS = 1_000
BATCH_BYTES = "16m"


def prepare_workers(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, and let them import this package from where the driver has it."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty); all other columns are left out, so no name can clash."""
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def on_arrow(kind: pa.DataType) -> Callable:
    """Make a function of Arrow arrays, which returns an array of ``kind``, one of columns."""

    def of_columns(function: Callable) -> Callable:
        # The UDF belongs to a session, so it is made when it is used.
        return lambda *columns: arrow_udf(function, returnType=from_arrow_type(kind))(*columns)

    return of_columns


@on_arrow(pa.string())
def fold_ascii(text: pa.Array) -> pa.Array:
    """Lower-case A-Z only; every other character stays."""
    return pc.ascii_lower(text)


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
