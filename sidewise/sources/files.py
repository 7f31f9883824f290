"""JSON files in and out, partition layout, manifests and CSV export."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import SCHEMA_VERSION

log = logging.getLogger(__name__)

PARTITION_COLUMNS = ["tournament_id", "season_id", "date"]
CORRUPT = "_corrupt_record"


def scan_ndjson_text(spark: SparkSession, root: str, layout: str = "", glob: str = "*") -> DataFrame:
    """Non-blank lines of all files below ``root`` as ``data``, with their file.

    ``layout`` declares the partition columns of the folders, such as
    ``tournament_id int, date string``; their filters prune folders.
    """
    schema = "value string" + (f", {layout}" if layout else "")
    lines = spark.read.schema(schema).option("pathGlobFilter", glob).text(root)
    partitions = [c for c in lines.columns if c != "value"]
    return lines.where(F.trim("value") != "").select(
        F.col("value").alias("data"), F.col("_metadata.file_path").alias("file_path"), *partitions
    )


def scan_ndjson(spark: SparkSession, root: str, schema: str, layout: str = "", glob: str = "*") -> DataFrame:
    """Records of all line-delimited files below ``root``, typed by ``schema``.

    A line that does not fit comes back with only ``_corrupt_record`` filled.
    Lines are parsed as a whole whatever columns are used later, so whether a
    line counts as corrupt does not depend on the query.
    """
    lines = scan_ndjson_text(spark, root, layout, glob)
    return typed_lines(lines, schema, [c for c in lines.columns if c not in ("data", "file_path")])


def typed_lines(lines: DataFrame, schema: str, partitions: Sequence[str]) -> DataFrame:
    """``partitions`` and the record in column ``data`` of each line."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json("data", f"{schema}, {CORRUPT} string", options)
    return lines.select(*partitions, F.inline(F.array(record)))


def well_formed(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def scan_json_documents(spark: SparkSession, root: str, key_pattern: str = r"match_(\d+)\.json", glob: str = "*.json") -> DataFrame:
    """One document per file as text, with the key taken from the file name."""
    docs = spark.read.option("wholetext", "true").option("pathGlobFilter", glob).text(root)
    path = F.col("_metadata.file_path")
    key = F.nullif(F.regexp_extract(path, key_pattern, 1), F.lit(""))
    return docs.select(
        key.cast("bigint").alias("match_id"), F.col("value").alias("data"), path.alias("file_path"),
        *[c for c in docs.columns if c != "value"],
    )


def path_partition(path: Column, name: str) -> Column:
    """Value of ``name=`` in a path; NULL without that segment."""
    return F.nullif(F.regexp_extract(path, f"{name}=([^/]+)", 1), F.lit(""))


def to_ndjson(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """Each row as compact JSON text in column ``value``."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def write_partitioned(
    df: DataFrame, root: str, by: Sequence[str] = PARTITION_COLUMNS, mode: str = "append",
    max_records: int = 1_000_000,
) -> None:
    """Write line-delimited JSON below ``root`` in ``by`` folders.

    ``append`` adds files, ``replace`` swaps the partitions in ``df`` in place; see
    ``snapshots`` for writes that show whole or not at all.
    The rebalance hint puts the rows of a folder together, yet splits a folder
    that is too large for one task and joins small ones, so neither many tiny
    files nor one huge file arises.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    writer = df.hint("rebalance", *by).write.partitionBy(*by).option("maxRecordsPerFile", max_records)
    if mode == "append":
        writer.mode("append").json(root)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(root)


def batch_manifest(df: DataFrame, by: Sequence[str], batch: str = "batch_id") -> DataFrame:
    """Per (partition, batch): record count and size of the joined NDJSON text."""
    payload = [c for c in df.columns if c not in (*by, batch)]
    text = F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})
    sized = df.select(*by, batch, F.octet_length(text).cast("bigint").alias("bytes"))
    counted = sized.groupBy(*by, batch).agg(
        F.count(F.lit(1)).alias("record_count"),
        # Lines are joined by newlines, so there is one less than there are records.
        (F.sum("bytes") + F.count(F.lit(1)) - 1).alias("file_size_bytes"),
    )
    return counted.withColumn("schema_version", F.lit(SCHEMA_VERSION))


def store_batch(df: DataFrame, root: str, manifests: str, by: Sequence[str], batch: str = "batch_id", mode: str = "append") -> bool:
    """Write records, then their manifest rows; a failed manifest does not undo the data."""
    write_partitioned(df, root, by, mode)
    try:
        batch_manifest(df, by, batch).withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(manifests)
    except Exception:  # noqa: BLE001 - the data are already safe
        log.exception("manifest of %s was not stored", root)
        return False
    return True


def get_manifest(manifests: DataFrame, **key: object) -> DataFrame:
    """Rows of one manifest; empty if absent."""
    for name, value in key.items():
        manifests = manifests.where(F.col(name) == F.lit(value))
    return manifests


def list_partitions(df: DataFrame, by: Sequence[str] = PARTITION_COLUMNS, **eq: object) -> DataFrame:
    """Distinct partition keys as text, optionally for some values only."""
    for name, value in eq.items():
        df = df.where(F.col(name) == F.lit(value))
    key = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by])
    return df.select(*by).distinct().select(key.alias("partition_key"))


def partition_stats(files: DataFrame, manifests: DataFrame, by: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """Files, manifests, records and size of every partition.

    ``files`` has one row per data file with its ``file_size``.
    """
    sizes = files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("batch_count"), F.sum("file_size").alias("total_size_bytes")
    )
    counts = manifests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("manifest_count"), F.sum("record_count").alias("total_records")
    )
    megabytes = F.round(F.col("total_size_bytes").cast("decimal(38,6)") / (1024 * 1024), 2)
    return sizes.join(counts, list(by), "left").select(
        *by,
        "batch_count",
        F.coalesce("manifest_count", F.lit(0)).alias("manifest_count"),
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        "total_size_bytes",
        megabytes.alias("total_size_mb"),
    )


def data_files(spark: SparkSession, root: str, layout: str, glob: str = "*") -> DataFrame:
    """One row per data file below ``root`` with its size; contents are not read."""
    files = spark.read.format("binaryFile").schema(
        f"path string, modificationTime timestamp, length bigint, content binary, {layout}"
    ).option("pathGlobFilter", glob).load(root)
    partitions = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select(*partitions, F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def export_csv_all(spark: SparkSession, tables: Sequence[str], out_dir: str) -> DataFrame:
    """Each table as CSV with header in its own folder; returns table and row count.

    Files are written by all tasks in parallel; rows are counted as they pass by.
    """
    from pyspark.sql import Observation

    counted = []
    for name in sorted(tables):
        seen = Observation()
        rows = spark.table(name).observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").option("header", "true").csv(f"{out_dir}/{name.split('.')[-1]}")
        counted.append((name, int(seen.get["n"])))
    return spark.createDataFrame(counted, "table_name string, row_count bigint")
