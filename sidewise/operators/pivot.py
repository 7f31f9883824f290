"""Long key/value statistics to wide columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import metric_key
from ..functions.measures import as_col

MAX_COLUMNS = 5_000


def stat_column(raw: str) -> str:
    return "stat_" + re.sub("[^a-z0-9]+", "_", raw.lower()).strip("_")


def name_columns(raw_keys: Sequence[str]) -> list[tuple[str, str]]:
    """(raw key, column name) in key order; a repeated name gets its 1-based position."""
    seen: set[str] = set()
    out = []
    for position, raw in enumerate(sorted(raw_keys), 1):
        name = stat_column(raw)
        out.append((raw, f"{name}_{position}" if name in seen else name))
        seen.add(name)
    return out


def metric_columns(df: DataFrame, key: str, name: str) -> list[tuple[str, str]]:
    """Distinct metric keys of ``df`` with their column names.

    This is a schema lookup: one value per *kind* of metric reaches the driver.
    The number is checked, because a free-text key would make no usable schema.
    """
    keys = df.select(metric_key(key, name).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    rows = keys.limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} distinct metric keys: '{key}' is not a metric name")
    return name_columns([row.raw for row in rows])


def agg_pivot(
    df: DataFrame,
    keys: Sequence[str],
    name: Column | str,
    values: dict[str, Column | str],
    columns: Sequence[tuple[str, str]],
) -> DataFrame:
    """One row per ``keys``; for each (raw, column) and each value prefix the maximum.

    ``values`` maps an output prefix to a value column, so the home and the away
    value of one metric pivot in the same aggregation.
    """
    metric = as_col(name)
    aggs = [
        F.max(F.when(metric == raw, as_col(value))).alias(prefix + column)
        for prefix, value in values.items()
        for raw, column in columns
    ]
    return df.groupBy(*keys).agg(*aggs)


def pivot_listed(
    df: DataFrame, keys: Sequence[str], name: str, values: Sequence[str], listed: Sequence[str], dealt: bool = False
) -> DataFrame:
    """One row per ``keys`` with an array per value column: its maxima by metric, in the order of ``sorted(set(listed))``.

    For wide pivots.  Cells move as narrow rows, once: by ``keys``, which also serves
    the step that makes metrics unique; not at all if they are ``dealt`` in buckets of some of the keys.  The cells of a row and blank ones for the
    metrics that it lacks are then sorted into place together, so no column
    searches them.  A row without any listed metric stays.
    """
    cells = [F.max(v).alias(v) for v in values]
    once = (df if dealt else df.repartition(*keys)).groupBy(*keys, name).agg(*cells)
    cell = F.struct(F.col(name).alias("metric"), *values)
    found = F.collect_list(F.when(F.col(name).isin(list(listed)), cell)).alias("found")
    kind = once.select(cell.alias("cell")).schema["cell"].dataType
    every = F.array(*[F.lit(raw) for raw in sorted(set(listed))]).cast("array<string>")
    blank = F.transform(
        F.array_except(every, F.transform("found", lambda c: c["metric"])),
        lambda raw: F.struct(raw.alias("metric"), *[F.lit(None).alias(v) for v in values]).cast(kind),
    )
    placed = once.groupBy(*keys).agg(found).select(*keys, F.array_sort(F.concat("found", blank)).alias("placed"))
    return placed.select(*keys, *[F.col("placed")[v].alias(v) for v in values])


def with_columns_present(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """Add the listed columns that ``df`` lacks as typed NULLs."""
    missing = {c: F.lit(None).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df
