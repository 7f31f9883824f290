from datetime import date

import pytest

from sidewise.operators import filters as P

DAY = 86400
CUTOFF = "2024-01-10"
MIDNIGHT = 1704844800  # 2024-01-10 UTC


def pages(spark, rows):
    return spark.createDataFrame(rows, "id int, page int, seconds bigint")


def test_newer_than_keeps_strictly_later_dates(spark):
    offsets = [1, 2, 0, -1]
    rows = [(n, 0, MIDNIGHT + o * DAY) for n, o in enumerate(offsets)] + [(9, 0, 0)]
    kept = P.filter_newer_than(pages(spark, rows), "seconds", CUTOFF)
    assert {r.id for r in kept.collect()} == {0, 1}


def test_date_range_without_bounds_keeps_undated(spark):
    df = pages(spark, [(1, 0, 0), (2, 0, MIDNIGHT)])
    assert P.filter_date_range(df, "seconds").count() == 2
    assert P.filter_date_range(df, "seconds", end=CUTOFF).count() == 1


@pytest.mark.parametrize(("old", "stops"), [(1, False), (8, True)])
def test_page_stops_above_four_fifths(spark, old, stops):
    rows = [(n, 0, MIDNIGHT + (-1 if n < old else 2) * DAY) for n in range(9)]
    assert P.page_stops(pages(spark, rows), "page", "seconds", CUTOFF).first().stops is stops


def test_scan_ends_after_the_first_old_page(spark):
    rows = [(n, 0, MIDNIGHT + 2 * DAY) for n in range(5)]
    rows += [(10 + n, 1, MIDNIGHT + (3 if n == 0 else -1) * DAY) for n in range(10)]
    rows += [(30, 2, MIDNIGHT + 5 * DAY)]
    got = P.scan_cutoff_page(pages(spark, rows), "page", "seconds", CUTOFF)
    assert {r.id for r in got.collect()} == {0, 1, 2, 3, 4, 10}


def test_scan_ends_before_an_empty_page_and_at_the_limit(spark):
    rows = [(0, 0, MIDNIGHT + DAY), (2, 2, MIDNIGHT + DAY)]
    assert P.scan_cutoff_page(pages(spark, rows), "page", "seconds", CUTOFF).count() == 1
    rows = [(n, n, MIDNIGHT + DAY) for n in range(6)]
    assert P.scan_cutoff_page(pages(spark, rows), "page", "seconds", CUTOFF, max_pages=4).count() == 4


def test_scan_has_no_limit_of_its_own(spark):
    rows = [(n, n, MIDNIGHT + DAY) for n in range(60)]
    assert P.scan_cutoff_page(pages(spark, rows), "page", "seconds", CUTOFF).count() == 60
    assert P.scan_cutoff_page(pages(spark, rows[1:]), "page", "seconds", CUTOFF).count() == 0


def test_stage_filter_null_rules(spark):
    matches = spark.createDataFrame(
        [(1, "finished", "Ended"), (2, "finished", "Removed"), (3, "finished", "Removed"), (4, None, "Ended"),
         (5, "postponed", "Ended"), (6, "finished", None), (7, "finished", None)],
        "match_id int, status_type string, status_description string",
    )
    stats = spark.createDataFrame([(2,), (2,), (6,)], "match_id int")
    assert {r.match_id for r in P.stage_filter(matches, stats).collect()} == {1, 2, 6}


def test_argument_checks():
    for bad in [(0, 1, 1), (1, -1, 1), (1, 1, 0)]:
        with pytest.raises(ValueError):
            P.validate_params(*bad)
    today = date(2024, 5, 1)
    assert P.validate_cutoff("2024-04-30", today) == date(2024, 4, 30)
    for bad in ("2024-05-02", "30.04.2024"):
        with pytest.raises(ValueError):
            P.validate_cutoff(bad, today)


def test_param_problem_names_the_first_fault(spark):
    rows = spark.createDataFrame([(1, 2, 3), (0, 2, 0), (1, None, 1), (1, 2, -1)], "t int, s int, p int")
    assert [r[0] for r in rows.select(P.param_problem("t", "s", "p")).collect()] == [
        None, "tournament_id must be positive, got 0", "season_id must be positive, got nothing", "max_pages must be positive, got -1",
    ]
