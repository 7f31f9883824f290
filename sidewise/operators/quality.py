"""Data-quality checks: each returns the violating rows, none means pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .filters import EXCLUDED_STATUSES, NOT_STAGED
from .sides import side_union


class QualityError(RuntimeError):
    """A gate found violations."""


@dataclass(frozen=True)
class Rule:
    """What a column must hold: each value once, no null, only values of ``parent`` (model, column) or of a list."""

    column: str
    unique: bool = False
    filled: bool = False
    parent: tuple[str, str] | None = None
    values: tuple = ()


def model_checks(models: dict[str, DataFrame], rules: dict[str, list[Rule]]) -> DataFrame:
    """model, column_name, test and violations for every rule over every model; 0 means pass.

    Nulls of all columns of a model are counted in one scan.  ``unique`` counts the values
    that occur again, ``relationships`` the rows without a parent, ``accepted_values`` the
    values off the list; none of these three counts nulls.
    """
    c, out = F.col, []

    def labelled(counted: DataFrame, model: str, column: str, test: str) -> DataFrame:
        return counted.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"), "violations")

    violations = F.count(F.lit(1)).alias("violations")
    for model, of in rules.items():
        df = models[model]
        filled = [r.column for r in of if r.filled]
        if filled:
            nulls = df.agg(*[F.count_if(c(name).isNull()).alias(name) for name in filled]).unpivot([], filled, "column_name", "violations")
            out.append(nulls.select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "violations"))
        for rule in of:
            if rule.unique:
                out.append(labelled(unique(df, [rule.column]).agg(violations), model, rule.column, "unique"))
            if rule.parent:
                parent, field = rule.parent
                out.append(labelled(relationships(df, rule.column, models[parent], field).agg(violations), model, rule.column, "relationships"))
            if rule.values:
                out.append(labelled(accepted_values(df, rule.column, rule.values).agg(violations), model, rule.column, "accepted_values"))
    return reduce(DataFrame.unionByName, out)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    present = df.dropna(how="any", subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL values of ``column`` without a parent row."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    return values.join(parent.select(F.col(parent_column).alias("from_field")), "from_field", "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def _side_totals(fact_match: DataFrame) -> DataFrame:
    return side_union(
        fact_match,
        ["season_id", "winner_code"],
        {"team_id": "home_team_id", "goals": "home_score", "win": F.lit(1), "loss": F.lit(2)},
        {"team_id": "away_team_id", "goals": "away_score", "win": F.lit(2), "loss": F.lit(1)},
    )


def goal_aggregation(mart_attack: DataFrame, fact_match: DataFrame) -> DataFrame:
    """Goals in the attack mart that differ from the facts."""
    silver = _side_totals(fact_match).groupBy("season_id", "team_id").agg(
        F.sum("goals").alias("total_goals_silver")
    )
    gold = mart_attack.select("season_id", "team_id", "team_name", F.col("total_goals").alias("goals_in_gold"))
    joined = gold.join(silver, ["season_id", "team_id"])
    return joined.where(F.col("goals_in_gold") != F.col("total_goals_silver")).withColumn(
        "difference", F.abs(F.col("goals_in_gold") - F.col("total_goals_silver"))
    )


def point_calculation(mart_overview: DataFrame, fact_match: DataFrame) -> DataFrame:
    """Points in the overview mart that differ from 3 / 1 / 0 over the facts."""
    code = F.col("winner_code")
    points = F.when(code == F.col("win"), 3).when(code == 3, 1).when(code == F.col("loss"), 0)
    calc = _side_totals(fact_match).groupBy("season_id", "team_id").agg(F.sum(points).alias("calc_points"))
    gold = mart_overview.select("season_id", "team_id", "team_name", F.col("total_points").alias("points_in_mart"))
    joined = gold.join(calc, ["season_id", "team_id"])
    return joined.where(F.col("points_in_mart") != F.col("calc_points")).withColumn(
        "difference", F.abs(F.col("points_in_mart") - F.col("calc_points"))
    )


def without_statistics(fact_match: DataFrame, fact_team_match: DataFrame) -> DataFrame:
    """Finished events that have no full-match statistics at all."""
    present = fact_team_match.where(F.col("period") == "ALL").select("match_id")
    columns = ["match_id", "season_name", "home_team_name", "away_team_name", "match_date"]
    return (
        fact_match.where(F.col("status_type") == "finished")
        .join(present, "match_id", "left_anti")
        .select(*columns, F.lit(0).cast("bigint").alias("teams_with_stats"))
    )


def orphans(details: DataFrame, parents: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    return details.join(parents.select(key), key, "left_anti").select(*keep)


def more_than(df: DataFrame, keys: Sequence[str], limit: int, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > limit)


def period_coherence(fact_team_match: DataFrame) -> DataFrame:
    return more_than(fact_team_match, ["match_id", "period"], 2, "rows_cnt")


def duplicate_team_match(fact_team_match: DataFrame) -> DataFrame:
    return more_than(fact_team_match, ["match_id", "team_id", "period"], 1, "duplicate_count")


def excluded_status(df: DataFrame) -> DataFrame:
    return df.where(F.col("status_type").isin(EXCLUDED_STATUSES)).select(
        "match_id", "status_type", "status_description"
    )


def score_consistency(fact_team_match: DataFrame, fact_match: DataFrame) -> DataFrame:
    """Sides whose two halves do not add up to the final score."""
    sides = side_union(
        fact_match,
        ["match_id"],
        {"team_id": "home_team_id", "goals_1st": "home_score_period1", "goals_2nd": "home_score_period2", "goals_all": "home_score"},
        {"team_id": "away_team_id", "goals_1st": "away_score_period1", "goals_2nd": "away_score_period2", "goals_all": "away_score"},
    ).drop("location")
    halves = F.coalesce("goals_1st", F.lit(0)) + F.coalesce("goals_2nd", F.lit(0))
    wrong = sides.where(halves != F.col("goals_all"))
    present = fact_team_match.where(F.col("period") == "ALL").select("match_id", "team_id")
    return wrong.join(present, ["match_id", "team_id"], "left_semi")


def stat_range(fact_team_match: DataFrame) -> DataFrame:
    """Possession outside 0..100, more accurate passes than passes, negative xG.

    The three rules are evaluated per row in one scan.
    """
    possession, passes = F.col("stat_ballpossession"), F.col("stat_passes")
    accurate, xg = F.col("stat_accuratepasses"), F.col("stat_expectedgoals")
    share = (accurate * 100).cast("decimal(28,6)") / F.nullif(passes, F.lit(0))

    def finding(bad: Column, name: str, value: Column) -> Column:
        return F.when(bad, F.struct(F.lit(name).alias("stat_name"), value.cast("double").alias("stat_value")))

    found = F.array_compact(
        F.array(
            finding((possession < 0) | (possession > 100), "ballpossession", possession),
            finding((passes > 0) & (accurate > passes), "accuratepasses_pct", share),
            finding(xg < 0, "expectedgoals", xg),
        )
    )
    return fact_team_match.select("match_id", "team_id", "period", F.inline(found))


def two_teams(fact_team_match: DataFrame) -> DataFrame:
    whole = fact_team_match.where(F.col("period") == "ALL")
    counted = whole.groupBy("match_id").agg(F.count_distinct("team_id").alias("team_count"))
    return counted.where(F.col("team_count") != 2)


def match_dates(fact_match: DataFrame, as_of: str) -> DataFrame:
    day, today = F.col("match_date"), F.lit(as_of).cast("date")
    odd = (
        (day > F.date_add(today, 7))
        | (F.year(day) < 2000)
        | (F.year(day) > F.year(today) + 1)
    )
    return fact_match.where(odd).select("match_id", "match_date", "season_year", "start_timestamp")


def staging_violations(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """(check_name, violations) for the four staging rules."""
    ids = ["match_id", "home_team_id", "away_team_id"]
    any_null = F.col(ids[0]).isNull() | F.col(ids[1]).isNull() | F.col(ids[2]).isNull()
    per_row = matches.agg(
        F.count_if(any_null).alias("NULL in key columns"),
        F.count_if(F.col("status_type").isin(NOT_STAGED)).alias("Excluded statuses"),
    )
    named = per_row.unpivot([], list(per_row.columns), "check_name", "violations")
    orphan = orphans(stats, matches, "match_id", ["match_id"]).agg(
        F.lit("Orphan statistics").alias("check_name"), F.count_distinct("match_id").alias("violations")
    )
    repeats = matches.groupBy("match_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.lit("Duplicate match_ids").alias("check_name"),
        F.coalesce(F.sum("n") - F.count("match_id"), F.lit(0)).alias("violations"),
    )
    return named.unionByName(orphan).unionByName(repeats)


def run_gate(checks: dict[str, DataFrame]) -> None:
    """Raise if a check has violating rows; stops each check at its first row."""
    failed = [name for name, rows in checks.items() if not rows.isEmpty()]
    if failed:
        raise QualityError("checks failed: " + ", ".join(failed))


def gate_staging(matches: DataFrame, stats: DataFrame) -> None:
    counts = {row.check_name: row.violations for row in staging_violations(matches, stats).collect()}
    failed = [f"{name}: {n} records" for name, n in sorted(counts.items()) if n]
    if failed:
        raise QualityError("staging validation failed: " + "; ".join(failed))


def gate_present(spark: SparkSession, tables: Sequence[str]) -> None:
    """Raise unless every table exists and holds a row."""
    for name in tables:
        if not spark.catalog.tableExists(name):
            raise QualityError(f"table {name} does not exist")
        if spark.table(name).isEmpty():
            raise QualityError(f"table {name} is empty")
