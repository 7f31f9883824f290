"""Join shapes that recur in the models.

No side is broadcast by hint: Catalyst picks a broadcast from measured sizes
and AQE splits skewed partitions of the sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_fill_join(base: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every ``base`` row, with the statistics of its key or 0."""
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in stats.columns if c not in on]
    return base.join(stats, list(on), "left").select(*base.columns, *filled)


def opponent_join(df: DataFrame, event: str, entity: str, value: str, out: str) -> DataFrame:
    """Attach the value of the other entity of the same event, NULL if it is alone.

    An equi join on the event; the inequality is only a residual condition.
    """
    other = df.select(F.col(event).alias("_event"), F.col(entity).alias("_other"), F.col(value).alias(out))
    same_event = F.col(event) == F.col("_event")
    return df.join(other, same_event & (F.col("_other") != F.col(entity)), "left").drop("_event", "_other")


def missing_from(df: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is absent from ``present`` (anti join over its distinct keys)."""
    return df.join(present.select(*on).distinct(), list(on), "left_anti")


def found_in(df: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(present.select(*on), list(on), "left_semi")


def first_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key; the least one, so that the choice is repeatable."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def key_presence(a: DataFrame, b: DataFrame, on: Sequence[str], in_a: str, in_b: str) -> DataFrame:
    """Distinct keys of both inputs with a flag for each.

    A tagged union and one aggregation replace the full outer join: repeated
    keys collapse before the exchange.
    """
    tagged = a.select(*on, F.lit(True).alias(in_a), F.lit(False).alias(in_b)).unionByName(
        b.select(*on, F.lit(False).alias(in_a), F.lit(True).alias(in_b))
    )
    return tagged.groupBy(*on).agg(F.max(in_a).alias(in_a), F.max(in_b).alias(in_b))


def set_compare(a: DataFrame, b: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Per group: sizes of both key sets, missing, extra and coverage percent."""
    flags = key_presence(a, b, [*by, key], "in_a", "in_b")
    n_a, n_b = F.count_if("in_a"), F.count_if("in_b")
    coverage = F.round((n_b * 100).cast("decimal(28,6)") / F.nullif(n_a, F.lit(0)), 1)
    return flags.groupBy(*by).agg(
        n_a.alias("expected"),
        n_b.alias("found"),
        F.count_if(F.col("in_a") & ~F.col("in_b")).alias("missing"),
        F.count_if(~F.col("in_a") & F.col("in_b")).alias("extra"),
        F.coalesce(coverage, F.lit(0)).alias("coverage_pct"),
    )


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL of labelled relations with the same columns."""
    out: DataFrame | None = None
    for label, df in parts.items():
        labelled = df.select(F.lit(label).alias(tag), *df.columns)
        out = labelled if out is None else out.unionByName(labelled)
    if out is None:
        raise ValueError("no relations to union")
    return out


def labelled_aggregates(df: DataFrame, scopes: dict[str, Column], aggs: Sequence[Column], tag: str) -> DataFrame:
    """Several filtered aggregates over one relation in one scan.

    Each row is expanded into the scopes it belongs to, then aggregated by scope;
    partial aggregation leaves one row per scope and task.
    """
    labels = F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in scopes.items()]))
    return df.select("*", F.explode(labels).alias(tag)).groupBy(tag).agg(*aggs)
