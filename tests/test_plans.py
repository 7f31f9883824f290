import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from registry.inputs import Inputs
from sidewise.operators import quality as Q
from sidewise.operators import ranking as R
from sidewise.operators.joins import opponent_join
from sidewise.operators.sides import side_union
from sidewise.plans import appearances as A
from sidewise.plans import gold, scorer, silver
from sidewise.operators.reports import season_start_year

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return Inputs(spark, SF)


def test_sides_come_from_one_scan_without_a_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    sides = side_union(orders, ["o_orderkey"], {"id": "o_custkey"}, {"id": "o_orderkey"})
    plan = plan_of(sides)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError):
        side_union(orders, [], {"a": "o_custkey"}, {"b": "o_custkey"})


def test_top_n_is_limited_before_the_exchange(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(R.last_n(orders, ["o_custkey"], [F.desc("o_orderdate")], 3))
    assert plan.count("WindowGroupLimit") == 2


def test_numbering_splits_a_hot_group_and_stays_exact(spark):
    rows = [("hot", n) for n in range(300)] + [("cold", n) for n in range(5)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k string, n int")
    got = R.numbered(df, ["k"], "n", F.floor(F.col("n") / 10), size="size").collect()
    assert len(got) == len(rows)
    assert all(r.position == r.n + 1 for r in got if r.k)
    assert {r.size for r in got if r.k == "hot"} == {300}


def test_lone_side_keeps_its_row(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 6), (2, 12, 7)], "m int, t int, x int")
    got = {(r.m, r.t, r.y) for r in opponent_join(df, "m", "t", "x", "y").collect()}
    assert got == {(1, 10, 6), (1, 11, 5), (2, 12, None)}


def test_overview_points_and_rates(data):
    rows = gold.mart_team_overview(A.team_sides(data.fact)).collect()
    assert rows
    for r in rows:
        assert r.total_points == 3 * r.wins + r.draws
        assert r.matches_played == r.wins + r.draws + r.losses
        assert abs(float(r.points_per_game) - r.total_points / r.matches_played) <= 0.005 + 1e-9


def test_form_points_follow_the_chosen_codes(data):
    standard = {(r.team_id, r.season_id): r for r in data.form().collect()}
    assert all(r.points_last_5 == 3 * r.wins_last_5 + r.draws_last_5 for r in standard.values())
    alternate = data.form(gold.ALTERNATE_CODES).collect()
    assert any(r.points_last_5 != standard[r.team_id, r.season_id].points_last_5 for r in alternate)
    assert all(r.last_5_results == standard[r.team_id, r.season_id].last_5_results for r in alternate)


def test_renamed_team_stays_one_row(spark, data):
    renamed = data.fact.withColumn("home_team_name", F.concat("home_team_name", F.lit("*")))
    form = gold.mart_team_form(renamed)
    assert form.count() == form.select("team_id", "season_id").distinct().count()


def test_probabilities_sum_to_hundred(data):
    rows = scorer.mart_match_predictions(data.fact, data.venue(), data.form(), "2001-08-01", days=4000).collect()
    assert len(rows) > 100
    priced = [r for r in rows if r.home_win_probability != 33 or r.away_win_probability != 33]
    for r in priced:
        total = float(r.home_win_probability + r.draw_probability + r.away_win_probability)
        assert total == pytest.approx(100, abs=0.15)


def test_totals_agree_between_long_and_wide(data):
    wide = A.season_totals_from_facts(data.fact, data.team_match(A.DEFENSE_METRICS), A.DEFENSE_METRICS)
    long = data.totals(A.DEFENSE_METRICS)

    def flat(df):
        return {tuple(r) for r in df.select("team_id", "season_id", F.explode("totals")).select("team_id", "season_id", "key", "value.*").collect()}

    assert flat(long) == flat(wide)


def test_duplicate_metric_in_two_groups_counts_once(spark, data):
    doubled = data.stats.unionByName(data.stats.withColumn("group_name", F.lit("other")))
    once = data.totals(["fouls"]).select("team_id", "season_id", F.col("totals")["fouls"]["total"].alias("t"))
    twice = A.season_totals(data.fact, silver.side_values(doubled), ["fouls"]).select("team_id", "season_id", F.col("totals")["fouls"]["total"].alias("t"))
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_period_and_metric_filters_reach_the_scan(data):
    plan = plan_of(data.totals(["fouls", "passes"]))
    assert "(period" in plan and "= ALL)]" in plan.split("PartitionFilters: ", 1)[1]
    assert "In(metric, [fouls,passes])" in plan


def test_gates(spark, data):
    Q.gate_staging(data.staged, data.staged_stats)
    with pytest.raises(Q.QualityError, match="Excluded statuses"):
        Q.gate_staging(data.matches, data.stats)
    with pytest.raises(Q.QualityError, match="does not exist"):
        Q.gate_present(spark, ["no_such_table"])
    one = spark.createDataFrame([(1,)], "x int")
    Q.run_gate({"fine": one.where("x > 1")})
    with pytest.raises(Q.QualityError, match="broken"):
        Q.run_gate({"fine": one.where("x > 1"), "broken": one})


def test_padded_names(data):
    row = silver.dim_date(data.staged, padded=True).where("month = 5").first()
    assert len(row.day_name) == 9 and row.month_name == "May      "


def test_season_labels(spark):
    rows = [("25/26",), ("98/99",), ("2013",), ("Unknown",)]
    got = spark.createDataFrame(rows, "y string").select(season_start_year(F.col("y"))).collect()
    assert [r[0] for r in got] == [2025, 1998, 2013, None]
