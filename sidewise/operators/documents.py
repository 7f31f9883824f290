"""Typed rows out of raw JSON documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions.cleaning import advantage, parse_extracted_at, side_share
from ..functions.measures import STAT_TYPE
from ..session import scratch_path, set_conf

EPOCH = "epoch"
#: How a statistics document in the bare form begins.
BARE_START = r'^\s*\{\s*"statistics"\s*:\s*\['
#: Levels of objects that a shape profile without a depth opens at first.
FIRST_LEVELS = 4

# Output column, path inside the document, type.
MATCH_COLUMNS = [
    ("match_id", "id", "bigint"),
    ("match_slug", "slug", "string"),
    ("custom_id", "customId", "string"),
    ("start_timestamp", "startTimestamp", EPOCH),
    ("status_code", "status.code", "int"),
    ("status_type", "status.type", "string"),
    ("status_description", "status.description", "string"),
    ("winner_code", "winnerCode", "int"),
    ("home_score_current", "homeScore.current", "int"),
    ("away_score_current", "awayScore.current", "int"),
    ("home_score_period1", "homeScore.period1", "int"),
    ("home_score_period2", "homeScore.period2", "int"),
    ("away_score_period1", "awayScore.period1", "int"),
    ("away_score_period2", "awayScore.period2", "int"),
    ("home_team_id", "homeTeam.id", "int"),
    ("home_team_name", "homeTeam.name", "string"),
    ("home_team_slug", "homeTeam.slug", "string"),
    ("home_team_short_name", "homeTeam.shortName", "string"),
    ("home_team_name_code", "homeTeam.nameCode", "string"),
    ("away_team_id", "awayTeam.id", "int"),
    ("away_team_name", "awayTeam.name", "string"),
    ("away_team_slug", "awayTeam.slug", "string"),
    ("away_team_short_name", "awayTeam.shortName", "string"),
    ("away_team_name_code", "awayTeam.nameCode", "string"),
    ("tournament_id", "tournament.id", "int"),
    ("tournament_name", "tournament.name", "string"),
    ("tournament_slug", "tournament.slug", "string"),
    ("unique_tournament_id", "tournament.uniqueTournament.id", "int"),
    ("season_id", "season.id", "int"),
    ("season_name", "season.name", "string"),
    ("season_year", "season.year", "string"),
    ("country_name", "tournament.category.country.name", "string"),
    ("country_alpha2", "tournament.category.country.alpha2", "string"),
    ("country_alpha3", "tournament.category.country.alpha3", "string"),
    ("round_number", "roundInfo.round", "int"),
    ("injury_time_2", "time.injuryTime2", "int"),
    ("current_period_start_timestamp", "time.currentPeriodStartTimestamp", EPOCH),
    ("is_editor", "isEditor", "boolean"),
    ("feed_locked", "feedLocked", "boolean"),
    ("final_result_only", "finalResultOnly", "boolean"),
    ("has_global_highlights", "hasGlobalHighlights", "boolean"),
    ("source", "_metadata.source", "string"),
    ("batch_id", "_metadata.batch_id", "string"),
    ("ingestion_timestamp", "_metadata.ingestion_timestamp", "timestamp"),
]
# The subset that the fixture list carries, plus the round name.
UPCOMING_COLUMNS = [
    c
    for c in MATCH_COLUMNS
    if c[0]
    in {
        "match_id", "match_slug", "custom_id", "start_timestamp",
        "status_code", "status_type", "status_description",
        "home_team_id", "home_team_name", "home_team_slug", "home_team_short_name",
        "away_team_id", "away_team_name", "away_team_slug", "away_team_short_name",
        "tournament_name", "tournament_slug", "season_name", "season_year", "round_number",
    }
] + [
    ("tournament_id_from_match", "tournament.id", "int"),
    ("season_id_from_match", "season.id", "int"),
    ("round_name", "roundInfo.name", "string"),
]


def typed(c: Column, dtype: str, strict: bool = True) -> Column:
    """Cast a text leaf; the lenient form gives NULL where the strict one raises."""

    def convert(target: str) -> Column:
        return c.cast(target) if strict else c.try_cast(target)

    if dtype == EPOCH:
        return F.timestamp_seconds(convert("bigint"))
    return convert(dtype)


def parse_once(df: DataFrame, json_col: str, schema: str, out: str, *keep: str) -> DataFrame:
    """``keep`` columns and the parsed document as struct ``out``.

    The one-element explode keeps the optimizer from copying the parse into
    filters on its fields, which would read every document twice.
    """
    return df.select(*keep, F.explode(F.array(F.from_json(json_col, schema))).alias(out))


def project(df: DataFrame, doc: str, columns: Sequence[tuple[str, str, str]], strict: bool, *extra: Column | str) -> DataFrame:
    fields = [typed(F.col(f"{doc}.{path}"), dtype, strict).alias(name) for name, path, dtype in columns]
    return df.select(*fields, *extra)


def flatten_match_json(raw: DataFrame, json_col: str = "data", strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One typed row per match document, given as JSON text or as a variant, with the ``keep`` columns of ``raw`` behind.

    Text is parsed once.  Of a stored variant the scan reads the paths in use only;
    a leaf is taken as text and then typed, so both forms give the same values.
    """
    docs = raw.where(F.col(json_col).isNotNull())
    if docs.schema[json_col].dataType.typeName() == "variant":
        leaves = [(name, F.try_variant_get(json_col, f"$.{path}", "string"), dtype) for name, path, dtype in MATCH_COLUMNS]
        return docs.select(*(typed(leaf, dtype, strict).alias(name) for name, leaf, dtype in leaves), *keep)
    return project(parse_once(docs, json_col, schemas.MATCH, "doc", *keep), "doc", MATCH_COLUMNS, strict, *keep)


def as_variant(raw: DataFrame, json_col: str = "data") -> DataFrame:
    """``raw`` with its JSON text as a variant; text that is no JSON becomes NULL."""
    return raw.withColumn(json_col, F.try_parse_json(json_col))


def stat_periods(c: Column) -> Column:
    """The period list of a statistics document in either envelope.

    ``coalesce`` stops at the first hit.  A text that begins like the bare form is parsed
    as such first: to fail as the wrapped one costs the JVM an exception and a second reading.
    It counts only if nothing in it is unfit, and then the wrapped form would hold no list.
    """
    begins_bare = F.substring(c, 1, 100).rlike(BARE_START)
    checked = F.from_json(F.when(begins_bare, c), schemas.STATS_BARE_CHECKED)
    # The parsed document is a variable of the lambda, so it is parsed once for both fields.
    fit = F.transform(F.array(checked), lambda d: F.when(d[schemas.UNFIT].isNull(), d["statistics"]))[0]
    wrapped = F.from_json(c, schemas.STATS_WRAPPED)["statistics"]["statistics"]
    bare = F.from_json(c, schemas.STATS_BARE)["statistics"]
    return F.coalesce(fit, wrapped, bare)


# Output column, field of an item, type.
ITEM_COLUMNS = [
    ("statistic_name", "name", "string"),
    ("statistic_key", "key", "string"),
    ("home_value_text", "home", "string"),
    ("away_value_text", "away", "string"),
    ("home_value_numeric", "homeValue", STAT_TYPE),
    ("away_value_numeric", "awayValue", STAT_TYPE),
    ("compare_code", "compareCode", "int"),
    ("statistics_type", "statisticsType", "string"),
    ("value_type", "valueType", "string"),
    ("render_type", "renderType", "int"),
]


def _item_fields(item: str, strict: bool) -> list[Column]:
    return [typed(F.col(f"{item}.{path}"), dtype, strict).alias(name) for name, path, dtype in ITEM_COLUMNS]


def explode_stats(raw: DataFrame, json_col: str = "data", keep: Sequence[str] = ("match_id",), strict: bool = True) -> DataFrame:
    """One row per statistic item; empty or missing lists give no row."""
    docs = raw.where(F.col(json_col).isNotNull())
    periods = docs.select(*keep, F.explode(stat_periods(F.col(json_col))).alias("p"))
    groups = periods.select(*keep, F.col("p.period").alias("period"), F.explode("p.groups").alias("g"))
    items = groups.select(
        *keep, "period", F.col("g.groupName").alias("group_name"), F.explode("g.statisticsItems").alias("i")
    )
    return items.select(*keep, "period", "group_name", *_item_fields("i", strict))


def _merged_entries(entries: Column, label: str, lists: str) -> Column:
    """``entries`` with one entry per value of ``label``; the arrays ``lists`` of equal labels are joined."""
    labels = F.array_distinct(F.transform(entries, lambda e: e[label]))

    def whole(value: Column) -> Column:
        same = F.filter(entries, lambda e: e[label].eqNullSafe(value))
        parts = F.filter(F.transform(same, lambda e: e[lists]), lambda part: part.isNotNull())
        return F.struct(value.alias(label), F.flatten(parts).alias(lists))

    # Only a document that does repeat a label is taken apart.
    return F.when(F.size(labels) < F.size(entries), F.transform(labels, whole)).otherwise(entries)


def one_entry_per_label(periods: Column) -> Column:
    """A period list in which no period comes twice and, within a period, no group."""
    merged = _merged_entries(periods, "period", "groups")
    return F.transform(
        merged, lambda p: F.struct(p["period"].alias("period"), _merged_entries(p["groups"], "groupName", "statisticsItems").alias("groups"))
    )


def stat_documents(raw: DataFrame, json_col: str = "data", carried: Sequence[str] = (), beside: DataFrame | None = None) -> DataFrame:
    """Both kinds of ``stat_document_kinds`` in one relation."""
    return reduce(DataFrame.unionByName, stat_document_kinds(raw, json_col, carried, beside))


def several_documents(raw: DataFrame, json_col: str = "data") -> DataFrame:
    """The ids of matches with more than one document, and how many."""
    docs = raw.where(F.col(json_col).isNotNull() & F.col("match_id").isNotNull())
    return docs.groupBy("match_id").agg(F.count(F.lit(1)).alias("_documents")).where("_documents > 1")


def stat_document_kinds(
    raw: DataFrame, json_col: str = "data", carried: Sequence[str] = (), beside: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """One row per match, first of those with one document, then of those with several: match_id, ``carried``, the columns of ``beside`` for that match_id, periods (as parsed).

    The documents of a match that has several are joined into one list; of
    ``carried`` the smallest value stays then.  Which matches these are is counted by
    id alone, so of documents stored by buckets of match_id nothing is shuffled.
    A document without match_id stands for itself.
    """
    docs = raw.where(F.col(json_col).isNotNull()).select("match_id", *carried, json_col)
    # The few narrow rows are hashed, so no document is sorted for a join.
    several = several_documents(raw, json_col).hint("shuffle_hash")
    parsed = lambda df: df.select("match_id", *carried, stat_periods(F.col(json_col)).alias("periods"))
    joined = parsed(docs.join(several, "match_id", "left_semi")).groupBy("match_id").agg(
        *(F.min(c).alias(c) for c in carried), F.flatten(F.collect_list("periods")).alias("periods")
    )
    # Both kinds are joined on their own: a union would lose the buckets.
    looked_up = lambda df: df if beside is None else df.join(beside.hint("shuffle_hash"), "match_id", "left")
    return looked_up(parsed(docs.join(several, "match_id", "left_anti"))), looked_up(joined)


def explode_counted_stats(documents: DataFrame, keep: Sequence[str] = ("match_id",), strict: bool = True) -> DataFrame:
    """One row per statistic item of ``stat_documents``, with order and counts taken inside the document.

    A document is a whole match, so the items of a group are sorted and numbered
    in its array and every count is a size; no row meets those of another document.
    """

    def size(c: Column) -> Column:
        return F.coalesce(F.size(c), F.lit(0)).cast("bigint")

    def in_period(p: Column) -> Column:
        return F.aggregate(F.coalesce(p["groups"], F.array()), F.lit(0).cast("bigint"), lambda n, g: n + F.greatest(size(g["statisticsItems"]), F.lit(0)))

    def counted(periods: Column) -> Column:
        filled = F.filter(F.flatten(F.transform(periods, lambda p: F.coalesce(p["groups"], F.array()))), lambda g: F.size(g["statisticsItems"]) > 0)
        names = F.array_compact(F.array_distinct(F.transform(filled, lambda g: g["groupName"])))
        labelled = F.filter(periods, lambda p: (in_period(p) > 0) & p["period"].isNotNull())
        return F.struct(
            periods.alias("periods"), F.transform(periods, in_period).alias("sizes"),
            F.aggregate(periods, F.lit(0).cast("bigint"), lambda n, p: n + in_period(p)).alias("total_statistics_count"),
            F.size(labelled).cast("bigint").alias("periods_count"), F.size(names).cast("bigint").alias("groups_count"),
        )

    # The one-element explodes keep parse and counts from being copied into what reads them; the document is
    # taken over into a new row by these two only.
    docs = documents.select(*keep, F.explode(F.array("periods")).alias("_raw")).where(F.col("_raw").isNotNull())
    docs = docs.select(*keep, F.explode(F.array(F.transform(F.array(one_entry_per_label(F.col("_raw"))), counted)[0])).alias("_d"))
    per_match = ["total_statistics_count", "periods_count", "groups_count"]
    periods = docs.select(*keep, *(F.col(f"_d.{c}").alias(c) for c in per_match), F.col("_d.sizes").alias("_sizes"), F.posexplode("_d.periods").alias("_n", "_p"))
    groups = periods.select(
        *keep, *per_match, F.col("_p.period").alias("period"), F.get("_sizes", "_n").alias("statistics_in_period"), F.explode("_p.groups").alias("_g")
    )
    items = groups.select(
        *keep, *per_match, "period", "statistics_in_period", F.col("_g.groupName").alias("group_name"),
        F.size("_g.statisticsItems").cast("bigint").alias("stats_count_in_group"), F.posexplode(F.sort_array("_g.statisticsItems")).alias("_at", "_i"),
    )
    return items.select(
        *keep, "period", "group_name", *_item_fields("_i", strict), (F.col("_at") + 1).cast("bigint").alias("stat_order_in_group"),
        "stats_count_in_group", "statistics_in_period", *per_match,
    )


def compare_sides(df: DataFrame) -> DataFrame:
    """Advantage, shares, difference and the two completeness flags."""
    home, away = F.col("home_value_numeric"), F.col("away_value_numeric")
    return df.withColumns(
        {
            "advantage": advantage(home, away),
            "home_percentage": side_share(home, away),
            "away_percentage": side_share(away, home),
            "value_difference": home - away,
            "has_numeric_values": home.isNotNull() & away.isNotNull(),
            "is_complete_statistic": F.col("statistic_key").isNotNull() & F.col("statistic_name").isNotNull(),
        }
    )


def with_group_counts(flat: DataFrame) -> DataFrame:
    """Order and size inside the group, and counts per match and per period, for matches of any size.

    One pre-aggregation at the grain of (group, first letters of the key) feeds
    every count through windows over that small relation, and its offsets let
    the numbering run inside a block, so a large group is spread over tasks.
    ``flat`` is read twice: pass a written table rather than a parse.
    """
    group = ["match_id", "period", "group_name"]
    blocked = flat.withColumn("_block", F.substring("statistic_key", 1, 3))
    blocks = blocked.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("n"))
    in_group, in_match = W.partitionBy(*group), W.partitionBy("match_id")
    before = in_group.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    counts = blocks.select(
        *group,
        "_block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"),
        F.sum("n").over(in_group).alias("stats_count_in_group"),
        F.sum("n").over(W.partitionBy("match_id", "period")).alias("statistics_in_period"),
        F.sum("n").over(in_match).alias("total_statistics_count"),
        # Period and group names are short labels, a few per match.
        F.size(F.collect_set("period").over(in_match)).cast("bigint").alias("periods_count"),
        F.size(F.collect_set("group_name").over(in_match)).cast("bigint").alias("groups_count"),
    )
    on = [blocked[c].eqNullSafe(counts[c]) for c in (*group, "_block")]
    added = [c for c in counts.columns if c not in (*group, "_block")]
    joined = blocked.join(counts, on).select(blocked["*"], *added)
    inside = W.partitionBy(*group, "_block").orderBy("statistic_key", "statistic_name")
    order = F.row_number().over(inside) + F.col("_offset")
    return joined.withColumn("stat_order_in_group", order).drop("_block", "_offset")


def unnest_upcoming(raw: DataFrame, json_col: str = "data", strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event of each fixture-list document, with the list's metadata."""
    doc = parse_once(raw, json_col, schemas.UPCOMING, "doc", *keep)
    meta = doc.select(
        *keep,
        typed(F.col("doc.metadata.tournament_id"), "int", strict).alias("tournament_id_metadata"),
        typed(F.col("doc.metadata.season_id"), "int", strict).alias("season_id_metadata"),
        typed(F.col("doc.metadata.extraction_date"), "date", strict).alias("extraction_date"),
        parse_extracted_at("doc.metadata.extracted_at").alias("extracted_at"),
        F.explode("doc.data.events").alias("event"),
    )
    extra = [*keep, "tournament_id_metadata", "season_id_metadata", "extraction_date", "extracted_at"]
    return project(meta, "event", UPCOMING_COLUMNS, strict, *extra)


def combine_pages(df: DataFrame, group: str, page: str, events: str, has_next: str) -> DataFrame:
    """Events of all pages of a group in page order, and whether more pages follow.

    The combined list is kept as rows (page, position) rather than one array, so
    a group of any size stays distributed.
    """
    last = df.groupBy(group).agg(
        F.max_by(has_next, page).alias("has_next_page"), F.count(F.lit(1)).alias("pages")
    )
    rows = df.select(group, page, F.posexplode(events).alias("position", "event"))
    return rows.join(last, group)


def extract_path(df: DataFrame, col: str, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Items at ``a``, ``a.b`` or ``a[*].b`` of a struct column, one row each.

    A missing list gives no row; a single object gives one.
    """
    if "[*]." in path:
        outer, inner = path.split("[*].", 1)
        nested = df.select(*keep, F.explode(f"{col}.{outer}").alias("_outer"))
        source = nested.select(*keep, F.col(f"_outer.{inner}").alias("item"))
    else:
        source = df.select(*keep, F.col(f"{col}.{path}").alias("item"))
    if source.schema["item"].dataType.typeName() != "array":
        return source.where(F.col("item").isNotNull())
    return source.select(*keep, F.explode("item").alias("item"))


# Required fields of the three record kinds and how they are checked.
MATCH_REQUIRED = {
    "id": "bigint", "status": "object", "homeTeam": "object", "awayTeam": "object", "tournament": "object",
}
TOURNAMENT_REQUIRED = {"id": "bigint", "name": "string", "slug": "string", "category": "object"}
SEASON_REQUIRED = {"id": "bigint", "name": "string", "year": "string"}
MATCH_OPTIONAL = {"startTimestamp": "bigint"}


def validation_errors(doc: Column, required: Mapping[str, str], optional: Mapping[str, str] | None = None) -> Column:
    """``array<string>`` with one entry per broken field of the parsed ``doc``, in field order."""

    def problem(name: str, kind: str, must: bool) -> Column:
        value = doc[name]
        if kind == "object":
            # A nested object arrives as JSON text.
            wrong = ~value.startswith("{")
        elif kind == "string":
            wrong = F.lit(False)
        else:
            wrong = value.try_cast(kind).isNull()
        absent = F.when(value.isNull(), F.lit(f"{name}: missing" if must else None))
        return absent.when(wrong, F.lit(f"{name}: not {'an object' if kind == 'object' else 'a ' + kind}"))

    checks = [problem(n, k, True) for n, k in required.items()]
    checks += [problem(n, k, False) for n, k in (optional or {}).items()]
    return F.array_compact(F.array(*checks))


def with_errors(
    df: DataFrame, json_col: str, required: Mapping[str, str], optional: Mapping[str, str] | None = None
) -> DataFrame:
    """Add ``errors``; only the checked fields are parsed, each document once."""
    fields = ",".join(f"`{name}`:string" for name in [*required, *(optional or {})])
    parsed = parse_once(df, json_col, f"struct<{fields}>", "_doc", *df.columns)
    return parsed.withColumn("errors", validation_errors(F.col("_doc"), required, optional)).drop("_doc")


def validate_records(
    df: DataFrame, json_col: str, required: Mapping[str, str], optional: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``errors``)."""
    checked = with_errors(df, json_col, required, optional)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def validation_summary(
    df: DataFrame, json_col: str, required: Mapping[str, str], optional: Mapping[str, str] | None = None
) -> DataFrame:
    ok = F.size("errors") == 0
    counted = with_errors(df, json_col, required, optional).agg(
        F.count_if(ok).alias("total_count"), F.count_if(~ok).alias("skipped_count")
    )
    status = F.when(F.col("total_count") > 0, "success").otherwise("failed")
    return counted.withColumn("validation_status", status)


def _values_inside(df: DataFrame, json_col: str, levels: int) -> DataFrame:
    """One row per value in the objects of a document, ``levels`` deep: path, type, n and whether members are left to open.

    A document is read and parsed once.  Where a step opens an object, the first of its members
    takes along what is known of it, so no row is there twice.
    """
    c, explode = F.col, df.sparkSession.tvf.variant_explode_outer

    def described(opened: DataFrame, path: Column, carried: Column) -> DataFrame:
        """Rows of the ``member`` of each object, or the row itself where nothing was opened."""
        fresh = c("key").isNotNull()
        schema = F.when(fresh, F.schema_of_variant("value"))
        rows = opened.select(
            F.when(fresh, F.concat(path, F.lit("."), "key")).otherwise(path).alias("path"), c("type").alias("before"), c("n").alias("size"),
            fresh.alias("fresh"), schema.alias("schema"), c("value").alias("v"), carried.alias("carried"),
        )
        # The name ends at what it is made of, at its digits or at a second word.
        kind = reduce(lambda text, end: F.substring_index(text, end, 1), ["<", "(", "_"], c("schema"))
        rows = rows.withColumn("type", F.when(c("fresh"), kind).otherwise(c("before")))
        size = F.when(c("type") == "OBJECT", F.size(F.try_variant_get("v", "$", "map<string,variant>")))
        size = size.when(c("type") == "ARRAY", F.size(F.try_variant_get("v", "$", "array<variant>")))
        return rows.select(
            "path", "type", F.when(c("fresh"), size).otherwise(c("size")).alias("n"),
            F.when(c("fresh") & (c("type") == "OBJECT"), c("v")).alias("v"), "carried",
        )

    known = F.struct("path", "type", "n", F.lit(False).alias("unopened"))
    none = F.array().cast("array<struct<path:string,type:string,n:int,unopened:boolean>>")
    # Members have keys; the items of an array have not.
    roots = df.select(F.try_parse_json(json_col).alias("v")).lateralJoin(explode(c("v").outer())).where(c("key").isNotNull())
    rows = described(roots.withColumns({"type": F.lit(None).cast("string"), "n": F.lit(None).cast("int")}), F.lit("$"), none)
    for _ in range(levels - 1):
        opened = rows.lateralJoin(explode(c("v").outer()))
        handed = F.when(c("key").isNull(), c("carried")).when(c("pos") == 0, F.concat("carried", F.array(known))).otherwise(none)
        rows = described(opened, c("path"), handed)
    last = F.struct("path", "type", "n", (c("v").isNotNull() & (c("n") > 0)).alias("unopened"))
    return rows.select(F.inline(F.concat("carried", F.array(last))))


def json_shape_profile(df: DataFrame, json_col: str, depth: int | None = None) -> DataFrame:
    """Paths of the documents with value type, number of rows and the largest size.

    Objects are opened until none is left, or down to ``depth``; sizes count the
    keys of an object or the items of an array.  Without ``depth`` the small profile
    is stored, and made again twice as deep while it ends at objects with members.
    """
    if depth is not None and depth < 1:
        raise ValueError("depth must be positive")
    levels = depth or FIRST_LEVELS
    while True:
        profile = _values_inside(df, json_col, levels).groupBy("path", "type").agg(
            F.count(F.lit(1)).alias("rows"), F.max("n").alias("max_size"), F.max("unopened").alias("_unopened")
        )
        if depth is not None:
            return profile.drop("_unopened")
        path = scratch_path(df.sparkSession, "shape-profile")
        # The opened levels make one large method, which the JVM would only interpret: Spark then runs them apart.
        with set_conf(df.sparkSession, spark__sql__codegen__hugeMethodLimit="8000"):
            profile.write.parquet(path)
        stored = df.sparkSession.read.schema(profile.schema).parquet(path)
        if stored.where("_unopened").isEmpty():
            return stored.drop("_unopened")
        levels *= 2
