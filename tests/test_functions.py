from decimal import Decimal

from pyspark.sql import functions as F

from sidewise.functions import cleaning, keys, measures
from sidewise.operators.pivot import name_columns


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_period_names_and_null(spark):
    rows = [("1H",), ("Second Half",), ("ft",), (None,), ("extra time",)]
    assert values(spark, cleaning.normalize_period("p"), rows, "p string") == ["1ST", "2ND", "ALL", "ALL", "ALL"]


def test_clean_metric_key(spark):
    rows = [("Shots on-target (%)",), ("",), (None,)]
    assert values(spark, cleaning.clean_metric_key("k"), rows, "k string") == ["shots_on_target_", "unknown", "unknown"]


def test_column_names_get_a_position_on_collision():
    assert name_columns(["b.c", "b c", "a"]) == [("a", "stat_a"), ("b c", "stat_b_c"), ("b.c", "stat_b_c_3")]


def test_date_bucket_of_undated_records(spark):
    rows = [(1704067200,), (0,), (None,)]
    assert values(spark, cleaning.date_bucket("s"), rows, "s bigint") == ["2024-01-01", "unknown", "unknown"]


def test_second_half_is_filled_only_where_possible(spark):
    rows = [(3, 1, None), (3, None, None), (3, 1, 2)]
    column = cleaning.fill_second_half("t", "a", "b")
    assert values(spark, column, rows, "t int, a int, b int") == [2, None, 2]


def test_shares_round_half_up_and_skip_zero_totals(spark):
    rows = [(Decimal(1), Decimal(7)), (Decimal(0), Decimal(0)), (None, Decimal(1))]
    schema = "h decimal(18,6), a decimal(18,6)"
    assert values(spark, cleaning.side_share("h", "a"), rows, schema) == [Decimal("12.50"), None, None]


def test_mean_rounds_half_away_without_binary_noise(spark):
    rows = [(1,)] * 199 + [(2,)]
    got = spark.createDataFrame(rows, "x int").agg(measures.mean("x", 2)).first()[0]
    assert got == Decimal("1.01")  # 1.005 exactly


def test_rates_count_null_as_false(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "x int")
    assert df.agg(measures.rate(F.col("x") > 0)).first()[0] == Decimal("33.3")


def test_batch_id_is_sixteen_hex_digits_and_repeatable(spark):
    params = keys.params_json(season=F.lit(1), page=F.lit(2))
    df = spark.range(1).select(keys.batch_id(F.lit("/e"), params).alias("b"), params.alias("p"))
    row = df.first()
    assert row.p == '{"page": 2, "season": 1}'
    assert len(row.b) == 16 and int(row.b, 16) >= 0


def test_surrogate_key_tells_null_from_empty(spark):
    rows = [("a", None), ("a", "")]
    got = values(spark, keys.surrogate_key("x", "y"), rows, "x string, y string")
    assert got[0] != got[1]
