"""The given tables seen as matches, statistics and raw documents.

Orders become matches (home team from the customer's nation, away team from
the keys), line items become long statistics.  Everything is derived by Spark,
so the inputs grow with the tables.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sidewise.functions.measures import STAT_TYPE
from sidewise.operators.documents import as_variant, compare_sides, several_documents
from sidewise.operators.filters import in_doubt
from sidewise.operators.joins import found_in
from sidewise.operators.pivot import metric_columns, name_columns
from sidewise.plans import appearances, bronze, gold, scorer, silver
from sidewise.session import scratch_path, set_conf, write_bucketed

METRICS = appearances.ALL_METRICS
GROUPS = ["Attack", "Defending", "Duels", "Goalkeeping", "Match overview", "Passes", "Shots"]
# Each line item counts for three metrics.
METRIC_OFFSETS = [0, 13, 26]
AS_OF = "2001-08-01"
#: Bytes of orders and line items that a bucket of the stored relations stands for at most.
BUCKET_BYTES = 8 << 20
#: About how many events a page of a fixture list holds.
PAGE_EVENTS = 100


def pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


# Written relations of this process: (application, data directory, name) -> path.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _write_parquet(self: Inputs, df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def _write_by_match(self: Inputs, df: DataFrame, path: str) -> str:
    return write_bucketed(df, path, "match_id", self.buckets)


def _write_in_order(self: Inputs, df: DataFrame, path: str) -> str:
    return write_bucketed(df, path, "match_id", self.buckets, in_order=True)


def _write_kinds(self: Inputs, kinds: list[DataFrame], path: str) -> str:
    # To see whether a kind has rows reads few columns, to write it all.
    rare = [kind for kind in kinds[1:] if not kind.isEmpty()]
    return write_bucketed(kinds[0], path, "match_id", self.buckets, more=rare, in_order=True)


def _sorted_groups(self: Inputs):
    """Lists are collected from rows that are sorted already, one group at a time, not from a hash table that sorts them again."""
    return set_conf(self.spark, spark__sql__execution__useObjectHashAggregateExec="false")


def _write_sorted_groups(self: Inputs, df: DataFrame, path: str) -> str:
    with _sorted_groups(self):
        return _write_by_match(self, df, path)


def _write_statistics(self: Inputs, kinds: list[DataFrame], path: str) -> str:
    with _sorted_groups(self):
        return _write_kinds(self, kinds if self.has_several_documents else kinds[:1], path)


def _write_side_values(self: Inputs, kinds: list[DataFrame], path: str) -> str:
    with _sorted_groups(self):
        return silver.write_side_values(kinds[0], path, self.buckets, kinds[1:] if self.has_several_documents else ())


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def written(build, write=_write_parquet, read=_read_parquet, shown=lambda df: df):
    """A relation kept as a parquet table in the shared folder of the session.

    These are the raw, bronze and long silver tables that all models read.  The
    first use writes the table, later uses of the same data directory read it.
    ``write`` stores what ``build`` gives and may name what ``read`` opens; ``shown``
    adds the columns that follow from the stored ones, row by row.
    """
    name = build.__name__

    def relation(self: Inputs) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, name)
            _WRITTEN[key] = write(self, build(self), path) or path
        return shown(read(self.spark, _WRITTEN[key]))

    def parts(self: Inputs) -> list[DataFrame]:
        if self.is_written(name):
            return [relation(self)]
        built = build(self)
        return [shown(df) for df in (built if isinstance(built, list) else [built])]

    relation.__doc__ = build.__doc__
    relation.parts = parts
    return property(relation)


#: A relation stored in buckets of match_id, so that joins and counts by match move nothing.
by_match = partial(written, write=_write_by_match, read=SparkSession.table)


# Each after those that it reads.
WRITTEN_RELATIONS = [
    "matches", "stat_cells", "match_documents", "match_variants", "full_matches", "stats_documents", "full_stats", "staged", "fact",
    "side_values", "upcoming_documents",
]


def labelled_stats(cells: DataFrame) -> DataFrame:
    """Long statistics out of the sums of each match, period and metric."""
    number = F.col("metric_index")
    scale = F.when(number == METRICS.index("expectedGoals"), F.lit(0.05).cast("decimal(18,6)")).otherwise(F.lit(1).cast("decimal(18,6)"))
    key = pick(METRICS, number)
    # A side without a value now and then.
    home = F.when((F.col("h") != 0) | (F.col("match_id") % 5 != 0), F.col("h"))
    rows = cells.select(
        "match_id", "period", "group_name",
        key.alias("statistic_key"),
        F.concat(F.lit("Name of "), key).alias("statistic_name"),
        F.when(number % 2 == 0, "positive").otherwise("negative").alias("statistics_type"),
        F.when(F.lower(key).like("%percent%") | (key == "ballPossession"), "percentage").otherwise("event").alias("value_type"),
        (home.cast("decimal(12,0)") * scale).cast(STAT_TYPE).alias("home_value_numeric"),
        (F.col("a").cast("decimal(12,0)") * scale).cast(STAT_TYPE).alias("away_value_numeric"),
    )
    text = {f"{s}_value_text": F.col(f"{s}_value_numeric").cast("double").cast("string") for s in ("home", "away")}
    return rows.withColumns(text)


def statistics_lists(grouped_cells: DataFrame) -> DataFrame:
    """The nested lists of the statistics documents, one row per match."""
    c = F.col
    item = F.struct(
        c("statistic_name").alias("name"), c("statistic_key").alias("key"),
        c("home_value_text").alias("home"), c("away_value_text").alias("away"),
        c("home_value_numeric").alias("homeValue"), c("away_value_numeric").alias("awayValue"),
        F.when(c("home_value_numeric") > c("away_value_numeric"), 1).otherwise(2).alias("compareCode"),
        c("statistics_type").alias("statisticsType"), c("value_type").alias("valueType"), F.lit(1).alias("renderType"),
    )
    # The narrow cells are sorted; what they are labelled with comes after, and the lists keep the order.
    cells = grouped_cells.sortWithinPartitions("match_id", "period", "group_name")
    groups = labelled_stats(cells).groupBy("match_id", "period", "group_name").agg(F.collect_list(item).alias("items"))
    group = F.struct(c("group_name").alias("groupName"), c("items").alias("statisticsItems"))
    periods = groups.groupBy("match_id", "period").agg(F.collect_list(group).alias("groups"))
    return periods.groupBy("match_id").agg(F.collect_list(F.struct("period", "groups")).alias("statistics"))


def statistics_text(lists: DataFrame) -> DataFrame:
    """Raw statistics documents out of their nested lists; those of even matches in the wrapped envelope."""
    c = F.col
    bare = F.to_json(F.struct("statistics"))
    wrapped = F.to_json(F.struct("match_id", F.struct("statistics").alias("statistics")))
    text = F.when(c("match_id") % 2 == 0, wrapped).otherwise(bare)
    # Never NULL, and known to be: who only needs the ids does not form the text.
    return lists.select("match_id", F.lit(202).alias("tournament_id"), F.coalesce(text, F.lit("{}")).alias("data"))


class Inputs:
    """Relations over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def buckets(self) -> int:
        """Buckets of the relations stored by match: the shuffle partitions, or more where the tables are large for them."""
        sizes = [int(str(self.table(n)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for n in ("orders", "lineitem")]
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(sizes) // BUCKET_BYTES))

    def is_written(self, name: str) -> bool:
        return (self.spark.sparkContext.applicationId, self.sf_dir, name) in _WRITTEN

    def parts(self, name: str) -> list[DataFrame]:
        """A written relation as it is stored or, where it is not, the plans of its parts.

        For a reader that goes through it once, so that nothing is stored on the way.  A union of the parts has no buckets.
        """
        return getattr(type(self), name).fget.parts(self)

    @cached_property
    def has_several_documents(self) -> bool:
        """Whether any match has several statistics documents; counted by id, no document is read."""
        (documents,) = self.parts("stats_documents")
        return not several_documents(documents).isEmpty()

    @by_match
    def matches(self) -> DataFrame:
        """Typed matches of all statuses."""
        orders, customer = self.table("orders"), self.table("customer")
        nation, region = self.table("nation"), self.table("region")
        home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("home_team_id"), F.col("n_name").alias("home_team_name"),
            F.col("n_regionkey").alias("tournament_id"), F.col("r_name").alias("tournament_name"),
        )
        away = nation.select(F.col("n_nationkey").alias("away_team_id"), F.col("n_name").alias("away_team_name"))
        key, price, day = F.col("match_id"), F.col("o_totalprice"), F.col("o_orderdate")
        year = F.year(day)

        def short(y: Column) -> Column:
            return F.substring(y.cast("string"), 3, 2)

        # The few columns that all others follow from are dealt out by match.
        played = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("match_id"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "c_nationkey"
        )
        base = played.repartition(self.buckets, "match_id").select(
            key,
            F.concat(F.lit("match-"), key).alias("match_slug"),
            F.when(key % 7 != 0, F.concat(F.lit("C"), key)).alias("custom_id"),
            day.alias("start_timestamp"),
            F.when(F.col("o_orderstatus") == "F", 100).when(F.col("o_orderstatus") == "O", 0).otherwise(60).alias("status_code"),
            F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "notstarted").otherwise("postponed").alias("status_type"),
            F.when(key % 41 == 0, "Removed").when(key % 43 == 0, "Abandoned").when(key % 47 == 0, "Canceled")
            .when(key % 53 != 0, "Ended").alias("status_description"),
            F.col("c_nationkey").alias("home_team_id"),
            ((F.col("o_custkey") * 7 + key) % 25).cast("int").alias("away_team_id"),
            (F.floor(price) % 5).cast("int").alias("home_score_current"),
            (F.floor(price / 7) % 4).cast("int").alias("away_score_current"),
            year.alias("season_id"),
            F.concat(F.lit("Season "), year).alias("season_name"),
            F.concat(short(year), F.lit("/"), short(year + 1)).alias("season_year"),
            F.when(key % 11 != 0, F.dayofyear(day).cast("int")).alias("round_number"),
            F.when(key % 13 == 0, (key % 9).cast("int")).alias("injury_time_2"),
            F.when(key % 13 == 0, day + F.expr("interval 1 hour")).alias("current_period_start_timestamp"),
            F.col("o_custkey").alias("cust_id"),
        )
        home_goals, away_goals = F.col("home_score_current"), F.col("away_score_current")
        first_known = F.col("match_id") % 19 != 0
        second_known = F.col("match_id") % 3 != 0

        def first(c: Column) -> Column:
            return F.floor(c / 2).cast("int")

        scored = base.where(F.col("home_team_id") != F.col("away_team_id")).select(
            "*",
            F.when(home_goals > away_goals, 1).when(home_goals < away_goals, 2).otherwise(3).alias("winner_code"),
            F.when(first_known, first(home_goals)).alias("home_score_period1"),
            F.when(second_known, home_goals - first(home_goals)).alias("home_score_period2"),
            F.when(first_known, first(away_goals)).alias("away_score_period1"),
            F.when(second_known, away_goals - first(away_goals)).alias("away_score_period2"),
        )
        return scored.join(home, "home_team_id").join(away, "away_team_id").withColumn(
            "country_name", F.col("tournament_name")
        )

    @by_match
    def stat_cells(self) -> DataFrame:
        """The sums behind the statistics: a narrow row per match, period and metric.

        Line items are dealt out by match once, before each turns into several cells.
        """
        c = F.col
        # Of a part key only the remainder counts, which takes less room on its way.
        part = F.when(c("l_partkey") >= 0, c("l_partkey") % len(METRICS)).otherwise(c("l_partkey")).alias("part")
        line = self.table("lineitem").select(
            c("l_orderkey").alias("match_id"), part, F.coalesce(c("l_linestatus") == "F", F.lit(False)).alias("first"),
            (c("l_linenumber") % 2 == 1).alias("odd"), c("l_quantity").cast("bigint").alias("quantity"),
        )
        index = (c("part") + c("shift")) % len(METRICS)
        # Sorted while they are few and narrow: sums come out in nearly that order, so the sort into buckets has little to do.
        dealt = line.repartition(self.buckets, "match_id").sortWithinPartitions("match_id")
        items = dealt.select("*", F.explode(F.array(*[F.lit(o) for o in METRIC_OFFSETS])).alias("shift"))
        items = items.select(
            "match_id", index.cast("int").alias("metric_index"), "first",
            F.when(c("odd"), c("quantity")).otherwise(0).alias("h"), F.when(c("odd"), 0).otherwise(c("quantity")).alias("a"),
        )
        halves = {"1ST": c("first"), "2ND": ~c("first")}
        sums = items.groupBy("match_id", "metric_index").agg(
            F.sum("h").alias("h"), F.sum("a").alias("a"),
            *[F.sum(F.when(half, c(side))).alias(f"{side}_{period}") for period, half in halves.items() for side in "ha"],
            *[F.count_if(half).alias(f"n_{period}") for period, half in halves.items()],
        )

        def cell(period: str, suffix: str, found: Column) -> Column:
            return F.struct(F.lit(period).alias("period"), c(f"h{suffix}").alias("h"), c(f"a{suffix}").alias("a"), found.alias("found"))

        cells = F.array(cell("ALL", "", F.lit(True)), *[cell(p, f"_{p}", c(f"n_{p}") > 0) for p in halves])
        return sums.select("match_id", "metric_index", F.inline(cells)).where("found").drop("found")

    @property
    def grouped_cells(self) -> DataFrame:
        return self.stat_cells.withColumn("group_name", pick(GROUPS, F.col("metric_index") % len(GROUPS)))

    @cached_property
    def stats(self) -> DataFrame:
        """Long statistics of three periods, with the derived comparison columns."""
        return compare_sides(labelled_stats(self.grouped_cells))

    @partial(by_match, write=_write_statistics, shown=compare_sides)
    def full_stats(self) -> list[DataFrame]:
        """The bronze statistics, from the documents; compared when they are read, which saves a third of their disk."""
        (documents,) = self.parts("stats_documents")
        return bronze.counted_stats_kinds(documents, self.full_matches)

    @partial(by_match, write=_write_kinds)
    def full_matches(self) -> list[DataFrame]:
        """The bronze matches, from the documents."""
        return bronze.full_matches_kinds(self.match_variants)

    # --- silver and gold relations: each from the stored one before it ------

    @partial(by_match, write=_write_side_values)
    def side_values(self) -> list[DataFrame]:
        """The long silver table, stored by period from the bronze statistics."""
        return self.parts("full_stats")

    @by_match
    def staged(self) -> DataFrame:
        """The staging table of matches."""
        return silver.staging_matches(self.full_matches, self.statistics_of(in_doubt(self.full_matches)))

    def statistics_of(self, matches: DataFrame) -> DataFrame:
        """The bronze statistics of some matches: where those of all are not stored, made from the documents of these."""
        wanted = matches.select("match_id").distinct().hint("shuffle_hash")
        if self.is_written("full_stats"):
            return found_in(self.full_stats, wanted, ["match_id"])
        if self.is_written("stats_documents"):
            documents = found_in(self.stats_documents, wanted, ["match_id"])
        else:
            documents = statistics_text(statistics_lists(found_in(self.grouped_cells, wanted, ["match_id"])))
        return bronze.full_stats_data(documents, self.full_matches)

    @cached_property
    def staged_stats(self) -> DataFrame:
        return silver.staging_stats(self.full_stats, self.staged)

    @by_match
    def fact(self) -> DataFrame:
        """The match fact that all marts read."""
        return silver.fact_match(self.staged)

    def team_match(self, metrics: list[str] | None = None) -> DataFrame:
        """Without ``metrics`` the columns are those of the keys that the statistics hold."""
        columns = metric_columns(self.full_stats, "statistic_key", "statistic_name") if metrics is None else name_columns(metrics)
        return silver.fact_team_match(self.side_values, self.staged, columns)

    def sides(self, metrics: list[str] = METRICS) -> DataFrame:
        return appearances.appearances(self.fact, self.side_values, metrics)

    def totals(self, metrics: list[str] = METRICS) -> DataFrame:
        return appearances.season_totals(self.fact, self.side_values, metrics)

    def history(self, targets: DataFrame | None) -> DataFrame:
        """The match fact, or what of it the features of the ``targets`` need."""
        return self.fact if targets is None else scorer.history_of(targets, self.fact)

    def form(self, codes: dict[str, int] = gold.STANDARD_CODES, targets: DataFrame | None = None) -> DataFrame:
        return gold.mart_team_form(self.history(targets), codes)

    def venue(self, codes: dict[str, int] = gold.STANDARD_CODES, targets: DataFrame | None = None) -> DataFrame:
        played, values = self.history(targets), self.side_values
        if targets is not None:
            values = values.join(played.select("match_id"), "match_id", "left_semi")
        return scorer.venue_features(appearances.appearances(played, values, appearances.SCORER_METRICS), codes)

    # --- raw documents -----------------------------------------------------

    @partial(by_match, write=_write_in_order)
    def match_documents(self) -> DataFrame:
        """Matches as JSON text in ``data``, with the ids and load columns of the raw table."""
        c = F.col
        seconds = F.unix_timestamp("start_timestamp")

        def team(side: str) -> Column:
            name = c(f"{side}_team_name")
            return F.struct(
                c(f"{side}_team_id").alias("id"), name.alias("name"), F.lower(name).alias("slug"),
                F.substring(name, 1, 6).alias("shortName"), F.right(name, F.lit(3)).alias("nameCode"),
            )

        def points(side: str) -> Column:
            return F.struct(
                c(f"{side}_score_current").alias("current"), c(f"{side}_score_period1").alias("period1"),
                c(f"{side}_score_period2").alias("period2"),
            )

        country = F.struct(c("country_name").alias("name"), F.substring("country_name", 1, 2).alias("alpha2"), F.substring("country_name", 1, 3).alias("alpha3"))
        tournament = F.struct(
            c("tournament_id").alias("id"), c("tournament_name").alias("name"), F.lower("tournament_name").alias("slug"),
            F.struct((c("tournament_id") + 200).alias("id")).alias("uniqueTournament"),
            F.struct(country.alias("country")).alias("category"),
        )
        document = F.struct(
            c("match_id").alias("id"), c("match_slug").alias("slug"), c("custom_id").alias("customId"),
            seconds.alias("startTimestamp"),
            F.struct(c("status_code").alias("code"), c("status_type").alias("type"), c("status_description").alias("description")).alias("status"),
            c("winner_code").alias("winnerCode"), points("home").alias("homeScore"), points("away").alias("awayScore"),
            team("home").alias("homeTeam"), team("away").alias("awayTeam"), tournament.alias("tournament"),
            F.struct(c("season_id").alias("id"), c("season_name").alias("name"), c("season_year").alias("year")).alias("season"),
            F.struct(c("round_number").alias("round"), F.concat(F.lit("Round "), c("round_number")).alias("name")).alias("roundInfo"),
            F.struct(c("injury_time_2").alias("injuryTime2"), F.when(c("injury_time_2").isNotNull(), seconds + 3600).alias("currentPeriodStartTimestamp")).alias("time"),
            (c("match_id") % 2 == 0).alias("isEditor"), F.lit(False).alias("feedLocked"),
            F.lit(True).alias("finalResultOnly"), (c("match_id") % 4 == 0).alias("hasGlobalHighlights"),
            F.struct(
                F.lit("feed").alias("source"), F.concat(F.lit("b"), c("season_id")).alias("batch_id"),
                F.date_format(c("start_timestamp") + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"),
            ).alias("_metadata"),
        )
        return self.matches.select(
            "match_id", "tournament_id", "season_id", F.to_json(document).alias("data"),
            F.concat(F.lit("b"), c("season_id")).alias("batch_id"),
            (c("start_timestamp") + F.expr("interval 1 day")).alias("ingestion_timestamp"),
        )

    @partial(by_match, write=_write_in_order)
    def match_variants(self) -> DataFrame:
        """The match documents as variants, which parquet stores shredded: parsed at load, never again."""
        return as_variant(self.match_documents)

    @cached_property
    def match_records(self) -> DataFrame:
        """The documents parsed into one struct column ``doc``."""
        from sidewise import schemas

        return self.match_documents.select("match_id", F.from_json("data", schemas.MATCH).alias("doc")).select("doc.*")

    @partial(by_match, write=_write_sorted_groups, shown=statistics_text)
    def stats_documents(self) -> DataFrame:
        """One statistics document per match; every other one in the wrapped envelope.

        A document holds one match's statistics, at most one entry per metric and
        period, so the nested lists are bounded by the metric list.  They are stored as
        columns, which takes less disk than the text; the text is formed when it is read.
        """
        return statistics_lists(self.grouped_cells)

    @written
    def upcoming_documents(self) -> DataFrame:
        """Fixture lists: not-started matches per customer, extracted on two days.

        The second extraction only has even matches and a later round.  A list longer
        than a page is dealt out over several by a hash, so none grows with the data.
        """
        c = F.col
        rows = self.matches.where(c("status_type") == "notstarted").select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("take"))
        rows = rows.where((c("take") == 1) | (c("match_id") % 2 == 0))
        event = F.struct(
            c("match_id").alias("id"), c("match_slug").alias("slug"), c("custom_id").alias("customId"),
            F.unix_timestamp("start_timestamp").alias("startTimestamp"),
            F.struct(c("status_code").alias("code"), c("status_type").alias("type"), c("status_description").alias("description")).alias("status"),
            F.struct(c("home_team_id").alias("id"), F.when(c("match_id") % 23 != 0, c("home_team_name")).alias("name")).alias("homeTeam"),
            F.struct(c("away_team_id").alias("id"), c("away_team_name").alias("name")).alias("awayTeam"),
            F.struct(c("tournament_id").alias("id"), c("tournament_name").alias("name")).alias("tournament"),
            F.struct(c("season_id").alias("id"), c("season_name").alias("name"), F.when(c("match_id") % 17 != 0, c("season_year")).alias("year")).alias("season"),
            F.struct((c("round_number") + c("take")).alias("round")).alias("roundInfo"),
        )
        keys = ["cust_id", "tournament_id", "season_id", "take"]
        # Only the lists that need several pages are joined, at most one in PAGE_EVENTS rows.
        long = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(c("n") > PAGE_EVENTS)
        long = long.select(*keys, F.ceil(c("n") / PAGE_EVENTS).alias("pages"))
        page = F.pmod(F.xxhash64("match_id"), F.coalesce("pages", F.lit(1))).cast("int")
        rows = rows.join(long, keys, "left").withColumn("page_index", page)
        lists = rows.groupBy(*keys, "page_index").agg(F.collect_list(event).alias("events"))
        day = F.concat(F.lit("2024-03-0"), c("take"))
        meta = F.struct(
            "tournament_id", "season_id", day.alias("extraction_date"),
            F.concat(day, F.lit("T08:00:00.000000+00:00")).alias("extracted_at"), "page_index", F.lit("feed").alias("source"),
        )
        data = F.struct("events", (c("take") == 1).alias("hasNextPage"))
        return lists.select(
            "tournament_id", "cust_id", "take",
            F.concat(F.lit("next_matches/tournament_id="), c("tournament_id"), F.lit("/date="), day, F.lit("/next_matches.json")).alias("file_path"),
            F.to_json(F.struct(data.alias("data"), meta.alias("metadata"))).alias("data"),
        )

    # --- events as a small-record feed --------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        """Events with the partition values of a record feed."""
        e = self.table("events")
        return e.select(
            "event_id", "user_id", "event_type", "value", "props", "ts",
            F.unix_timestamp("ts").alias("seconds"),
            (F.col("user_id") % 5).cast("int").alias("tournament_id"),
            F.lit(2024).alias("season_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
        )
