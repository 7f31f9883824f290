"""Coverage, completeness and load reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.cleaning import epoch_date
from ..functions.measures import percent
from .filters import FINISHED_WORDS
from .joins import key_presence, labelled_aggregates
from .ranking import last_n

# Expected matches of a season and the status limits in percent.
EXPECTED_MATCHES = 306
COMPLETENESS = [(95, "COMPLETE"), (75, "SUBSTANTIAL"), (25, "PARTIAL")]
RECENT_YEAR = 2020


def _n() -> Column:
    return F.count(F.lit(1))


def incremental_report(staged: DataFrame, mark: str) -> DataFrame:
    """Counts and dates of everything and of what lies after the old high-water mark."""
    day = F.to_date("start_timestamp")
    newer = F.col("start_timestamp") > F.lit(mark).cast(staged.schema["start_timestamp"].dataType)
    return labelled_aggregates(
        staged,
        {"All Data": F.lit(True), "Newly Added": newer},
        [_n().alias("total_matches"), F.min(day).alias("earliest_match"), F.max(day).alias("latest_match")],
        "data_range",
    )


def staging_summary(matches: DataFrame, stats: DataFrame) -> DataFrame:
    day = F.to_date("start_timestamp")
    first = matches.agg(
        F.lit("Staging Matches").alias("table_name"),
        _n().alias("total_records"),
        F.count_distinct("match_id").alias("unique_matches"),
        F.min(day).alias("earliest_match"),
        F.max(day).alias("latest_match"),
        F.count_distinct("season_name").alias("seasons"),
        F.count_distinct("tournament_id").alias("tournaments"),
    )
    no_date = F.lit(None).cast("date")
    second = stats.agg(
        F.lit("Staging Stats").alias("table_name"),
        _n().alias("total_records"),
        F.count_distinct("match_id").alias("unique_matches"),
        no_date.alias("earliest_match"),
        no_date.alias("latest_match"),
        F.count_distinct("group_name").alias("seasons"),
        F.count_distinct("statistic_key").alias("tournaments"),
    )
    return first.unionByName(second)


def stats_by(stats: DataFrame, *keys: str) -> DataFrame:
    return stats.groupBy(*keys).agg(
        _n().alias("total_records"),
        F.count_distinct("match_id").alias("matches"),
        F.count_distinct("statistic_key").alias("unique_stats"),
    )


def by_season(staged: DataFrame) -> DataFrame:
    """``unique_teams`` adds home and away teams, so a team usually counts twice."""
    day = F.to_date("start_timestamp")
    return staged.groupBy("season_name").agg(
        _n().alias("matches"),
        (F.count_distinct("home_team_id") + F.count_distinct("away_team_id")).alias("unique_teams"),
        F.min(day).alias("first_match"),
        F.max(day).alias("last_match"),
    )


def missing_stats(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """Matches without statistics; ``should_have`` tells the finished ones."""
    finished = F.lower("status_type").isin(FINISHED_WORDS)
    # A stored id column looks small enough to broadcast while it has a hundred rows a match: those would go through the driver.
    ids = stats.select("match_id").distinct().hint("shuffle_hash")
    return matches.join(ids, "match_id", "left_anti").select(
        "match_id", "start_timestamp", "status_type", "status_description", "home_team_name",
        "away_team_name", "home_score_current", "away_score_current",
        F.coalesce(finished, F.lit(False)).alias("should_have"),
    )


def _with_presence(matches: DataFrame, stats: DataFrame) -> DataFrame:
    found = stats.select("match_id").distinct().withColumn("_found", F.lit(True))
    joined = matches.join(found, "match_id", "left")
    return joined.withColumn("has_stats", F.coalesce("_found", F.lit(False))).drop("_found")


def coverage(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """Finished matches, those with statistics, and the rest."""
    finished = matches.where(F.col("status_type") == "finished").select("match_id").distinct()
    with_stats = F.count_if("has_stats")
    return _with_presence(finished, stats).agg(
        _n().alias("total_finished_matches"),
        with_stats.alias("matches_with_stats"),
        (_n() - with_stats).alias("missing_stats"),
    )


def coverage_pct(matches: DataFrame, stats: DataFrame, *by: str) -> DataFrame:
    with_stats = F.count_if("has_stats")
    aggs = [
        _n().alias("total_matches"),
        with_stats.alias("matches_with_stats"),
        percent(with_stats, _n(), 2).alias("coverage_pct"),
        F.min("season_name").alias("first_season"),
        F.max("season_name").alias("last_season"),
    ]
    return _with_presence(matches, stats).groupBy(*by).agg(*aggs)


def load_counts(records: DataFrame, loaded: DataFrame, key: str, in_scope: Column, order_by: Sequence[Column]) -> DataFrame:
    """Rows per outcome of a load: loaded, duplicate, out_of_scope, malformed.

    ``records`` carries ``_corrupt_record``.  Repeats are found by counting per
    key, not by ranking: of n usable records with one key, one loads unless the
    key is already there.
    """
    bad = F.col("_corrupt_record").isNotNull()
    kind = F.when(bad, "malformed").when(~F.coalesce(in_scope, F.lit(False)), "out_of_scope").otherwise("usable")
    per_key = records.withColumn("kind", kind).groupBy("kind", key).agg(_n().alias("n"))
    known = loaded.select(key).distinct().withColumn("_known", F.lit(True))
    usable = F.col("kind") == "usable"
    joined = per_key.join(known, key, "left")
    takes = F.when(usable & F.col("_known").isNull(), 1).otherwise(0)
    rows = joined.agg(
        F.coalesce(F.sum(takes), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.when(usable, F.col("n")) - takes), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.when(F.col("kind") == "out_of_scope", F.col("n"))), F.lit(0)).alias("out_of_scope"),
        F.coalesce(F.sum(F.when(F.col("kind") == "malformed", F.col("n"))), F.lit(0)).alias("malformed"),
    )
    return rows.unpivot([], ["loaded", "duplicate", "out_of_scope", "malformed"], "outcome", "records")


def completeness_status(pct: Column, found: Column) -> Column:
    out = F.lit("MINIMAL")
    for least, name in reversed(COMPLETENESS):
        out = F.when(pct >= least, name).otherwise(out)
    return F.when(found == 0, "MISSING").otherwise(out)


def season_completeness(manifests: DataFrame, seasons: DataFrame, expected: int = EXPECTED_MATCHES) -> DataFrame:
    """Stored against expected matches for every known or stored season.

    ``manifests``: season_id, date, record_count.  ``seasons``: season_id,
    season_name, season_year.
    """
    dated = F.regexp_extract(F.col("date").cast("string"), r"^\d{4}-\d{2}-\d{2}$", 0)
    day = F.nullif(dated, F.lit(""))
    stored = manifests.groupBy("season_id").agg(
        F.sum("record_count").alias("matches_found"),
        _n().alias("total_batches"),
        F.count_distinct(day).alias("unique_dates"),
        F.min(day).alias("earliest"),
        F.max(day).alias("latest"),
        F.count_if(F.col("record_count") == 0).alias("empty_batches"),
        F.lit(True).alias("in_bronze"),
    )
    joined = seasons.withColumn("in_api", F.lit(True)).join(stored, "season_id", "full_outer")
    found = F.coalesce("matches_found", F.lit(0))
    ratio = found.cast("decimal(28,6)") * 100 / expected
    return joined.select(
        "season_id",
        F.coalesce("season_name", F.lit("Unknown")).alias("season_name"),
        F.coalesce("season_year", F.lit("Unknown")).alias("season_year"),
        completeness_status(ratio, found).alias("status"),
        F.coalesce("in_bronze", F.lit(False)).alias("in_bronze"),
        F.coalesce("in_api", F.lit(False)).alias("in_api"),
        found.alias("matches_found"),
        F.lit(expected).alias("expected_matches"),
        F.round(ratio, 1).alias("completion_percentage"),
        F.coalesce("unique_dates", F.lit(0)).alias("unique_dates"),
        F.coalesce("total_batches", F.lit(0)).alias("total_batches"),
        "earliest",
        "latest",
        F.coalesce("empty_batches", F.lit(0)).alias("quality_issues"),
    )


def season_start_year(c: Column) -> Column:
    """First year of ``25/26`` or ``2025``; two digits above 70 are of the 1900s."""
    head = F.regexp_extract(c, r"^(\d+)", 1)
    number = F.nullif(head, F.lit("")).cast("int")
    short = F.when(number > 70, number + 1900).otherwise(number + 2000)
    return F.when(F.length(head) <= 2, short).otherwise(number)


def backfill_priority(report: DataFrame, as_text: bool = False) -> DataFrame:
    """Seasons to fetch again, recent ones flagged, in order of work.

    ``as_text`` compares the label with the year as strings, where ``25/26``
    counts as recent and ``20/21`` does not; otherwise the start year counts.
    """
    recent = (
        F.col("season_year") >= str(RECENT_YEAR) if as_text else season_start_year(F.col("season_year")) >= RECENT_YEAR
    )
    missing = F.col("status") == "MISSING"
    open_seasons = report.where(F.col("status") != "COMPLETE")
    return open_seasons.select(
        "season_id",
        "season_year",
        "status",
        F.when(missing, "missing").otherwise("incomplete").alias("kind"),
        F.coalesce(recent, F.lit(False)).alias("is_recent"),
        F.when(~F.coalesce(recent, F.lit(False)), "none").when(missing, "high").otherwise("medium").alias("priority"),
    )


def next_steps(priorities: DataFrame) -> DataFrame:
    """The first five missing and the first three incomplete seasons."""
    ranked = last_n(priorities, ["kind"], [F.asc("season_id")], 5, "step")
    return ranked.where((F.col("kind") == "missing") | (F.col("step") <= 3))


# How each outcome of a fetch counts.
OUTCOME_CLASS = {
    "success": "successful", "skipped": "skipped", "not_found": "skipped",
    "save_failed": "failed", "fetch_failed": "failed", "error": "failed",
}


def fetch_outcomes(log: DataFrame, status: str = "status") -> DataFrame:
    classes = {
        name: F.count_if(F.col(status).isin([s for s, c in OUTCOME_CLASS.items() if c == name]))
        for name in ("successful", "failed", "skipped")
    }
    return log.agg(*[c.alias(n) for n, c in classes.items()], _n().alias("total"))


def day_listing(matches: DataFrame, day: str) -> DataFrame:
    """Display fields of the matches of one day, with defaults for what is missing."""
    seconds = F.col("startTimestamp")
    home, away = F.col("homeScore.current"), F.col("awayScore.current")
    text = F.concat(F.lit("("), home, F.lit("-"), away, F.lit(")"))
    return matches.where(epoch_date(seconds) == F.lit(day).cast("date")).select(
        F.col("id").cast("bigint").alias("match_id"),
        F.date_format(F.timestamp_seconds(seconds.cast("bigint")), "HH:mm").alias("time"),
        F.coalesce("homeTeam.name", F.lit("Unknown")).alias("home"),
        F.coalesce("awayTeam.name", F.lit("Unknown")).alias("away"),
        F.coalesce("status.type", F.lit("Unknown")).alias("status"),
        F.coalesce(text, F.lit("")).alias("score"),
        F.coalesce("roundInfo.round", F.lit("N/A")).alias("round"),
        F.coalesce("venue.stadium.name", F.lit("N/A")).alias("venue"),
    )


def list_dates(df: DataFrame, day: str = "date") -> DataFrame:
    return df.select(day).distinct().orderBy(F.desc(day))


def league_catalog(leagues: DataFrame, country: str, order: str, n: int = 2) -> DataFrame:
    """The first ``n`` leagues of each country with their division label."""
    top = last_n(leagues, [country], [F.asc(order)], n, "place")
    suffix = F.when(F.col("place") == 1, "st Division").otherwise("nd Division")
    return top.withColumn("division", F.concat(F.col("place").cast("string"), suffix))


def leagues_by_country(catalog: DataFrame, country: str, name: str) -> DataFrame:
    """Names per country in order of division: at most ``n`` entries each."""
    entries = F.array_sort(F.collect_list(F.struct("place", F.col(name).alias("league"))))
    return catalog.groupBy(country).agg(F.transform(entries, lambda e: e["league"]).alias("leagues"))


def group_count_histogram(stats: DataFrame) -> DataFrame:
    """Matches by number of statistic groups, with their share."""
    per_match = stats.groupBy("match_id").agg(F.count_distinct("group_name").alias("groups_count"))
    counted = per_match.groupBy("groups_count").agg(_n().alias("matches_count"))
    # One row per distinct group count reaches this window.
    total = F.sum("matches_count").over(W.partitionBy())
    return counted.withColumn("percentage", percent(F.col("matches_count"), total, 2))


def period_coverage_type(stats: DataFrame) -> DataFrame:
    has = {p: F.max(F.when(F.col("period") == p, 1).otherwise(0)) for p in ("ALL", "1ST", "2ND")}
    per_match = stats.groupBy("match_id").agg(*[c.alias(p) for p, c in has.items()])
    kind = (
        F.when((F.col("ALL") == 1) & (F.col("1ST") == 1) & (F.col("2ND") == 1), "Complete (ALL + 1ST + 2ND)")
        .when((F.col("ALL") == 1) & (F.col("1ST") == 0) & (F.col("2ND") == 0), "Only ALL period")
        .otherwise("Partial")
    )
    counted = per_match.groupBy(kind.alias("coverage_type")).agg(_n().alias("matches_count"))
    total = F.sum("matches_count").over(W.partitionBy())
    return counted.withColumn("percentage", percent(F.col("matches_count"), total, 2))


def stat_popularity(stats: DataFrame) -> DataFrame:
    """Matches that have each statistic, as count and share of matches with statistics."""
    keys = ["statistic_name", "group_name", "statistics_type", "value_type"]
    total = stats.agg(F.count_distinct("match_id").alias("n"))
    counted = stats.groupBy(*keys).agg(F.count_distinct("match_id").alias("matches_count"))
    return counted.withColumn("percentage", percent(F.col("matches_count"), total.scalar(), 2))


def season_depth(matches: DataFrame, stats: DataFrame, period: str = "ALL") -> DataFrame:
    """Per season: matches with statistics and the spread of statistics per match."""
    per_match = stats.where(F.col("period") == period).groupBy("match_id").agg(_n().alias("stats"))
    joined = matches.select("match_id", "season_name").join(per_match, "match_id")
    return joined.groupBy("season_name").agg(
        _n().alias("complete_matches"),
        F.min("stats").alias("min_stats"),
        F.max("stats").alias("max_stats"),
        F.round(F.sum("stats").cast("decimal(28,6)") / _n(), 0).cast("bigint").alias("avg_stats"),
    )


def id_overlap(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each id column: values only in ``a``, only in ``b``, and in both."""
    out: DataFrame | None = None
    for column in columns:
        flags = key_presence(
            a.where(F.col(column).isNotNull()), b.where(F.col(column).isNotNull()), [column], "in_a", "in_b"
        )
        row = flags.agg(
            F.lit(column).alias("id_column"),
            F.count_if(F.col("in_a") & ~F.col("in_b")).alias("only_first"),
            F.count_if(~F.col("in_a") & F.col("in_b")).alias("only_second"),
            F.count_if(F.col("in_a") & F.col("in_b")).alias("common"),
        )
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no columns given")
    return out


def table_columns(df: DataFrame) -> DataFrame:
    """Name, type, nullability and position of the columns of ``df``."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)
    ]
    schema = "ordinal_position int, column_name string, data_type string, is_nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def fixture_summary(upcoming: DataFrame) -> DataFrame:
    return upcoming.agg(
        _n().alias("total_matches"),
        F.count_distinct("match_id").alias("unique_matches"),
        F.min("start_timestamp").alias("earliest_match"),
        F.max("start_timestamp").alias("latest_match"),
        F.count_distinct("tournament_id_from_match").alias("tournaments"),
        F.count_distinct("season_id_from_match").alias("seasons"),
    )
