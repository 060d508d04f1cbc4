import hashlib
from collections import Counter

import pytest

from compare import DATA
from corpusmill.llm.quota import divisor_ranks, divisor_sample, quota_report


def brute(records, targets, size):
    """All priorities sorted at once; ranks as the operator gives them."""
    out = []
    for line, share, floor in targets:
        for rank in range(1, records.get(line, 0) + 1):
            out.append((rank > floor, (rank - 0.5) / share if share else float("inf"), line))
    floors = [x for x in out if not x[0]]
    rest = sorted(x for x in out if x[0] and x[1] != float("inf"))
    return Counter(x[2] for x in floors + rest[: max(0, size - len(floors))])


@pytest.mark.parametrize("size, slice_rows", [(30, 1), (30, 7), (200, 5), (5, 20_000), (1_000, 50)])
def test_seats_equal_brute_force(spark, size, slice_rows):
    records = {1: 100, 2: 40, 3: 3, 4: 60}
    targets = [(1, 0.5, 2), (2, 0.2, 0), (3, 0.25, 5), (4, 0.0, 4), (5, 0.05, 3)]
    df = spark.createDataFrame([(f"{c}-{i}", c) for c, n in records.items() for i in range(n)] + [("none", None)], "id string, target_id int")
    goals = spark.createDataFrame([(*t, size) for t in targets], "target_id int, target_share double, min_rows int, sample_size int")
    drawn = divisor_sample(df, goals, salts=4, slice_rows=slice_rows)
    rows = drawn.collect()
    assert Counter(r.target_id for r in rows) == brute(records, targets, size)
    assert len({r.id for r in rows}) == len(rows)
    report = {r.target_id: r for r in quota_report(divisor_ranks(df, goals, salts=4, slice_rows=slice_rows), goals).collect()}
    assert len(report) == 5 and not report[5].is_met and report[5].n_drawn == 0
    seats = brute(records, targets, size)
    for t, share, floor in targets:
        r = report[t]
        assert (r.n_available, r.n_drawn, r.is_met) == (records.get(t, 0), seats[t], records.get(t, 0) >= max(floor, share * size))


def test_sample_is_random_but_repeatable(spark):
    df = spark.createDataFrame([(f"r{i}", 1) for i in range(300)], "id string, target_id int")
    goals = spark.createDataFrame([(1, 1.0, 0, 30)], "target_id int, target_share double, min_rows int, sample_size int")
    first = {r.id for r in divisor_sample(df, goals).collect()}
    assert first == {r.id for r in divisor_sample(df.repartition(7), goals).collect()}
    assert first != {r.id for r in divisor_sample(df, goals, seed="2").collect()} and len(first) == 30
    assert hashlib.md5(b"1-r0").hexdigest()  # the order is by this hash


def test_empty(spark):
    goals = spark.createDataFrame([(1, None, None, 30)], "target_id int, target_share double, min_rows int, sample_size int")
    df = spark.createDataFrame([], "id string, target_id int")
    assert divisor_sample(df, goals).count() == 0
    assert quota_report(divisor_ranks(df, goals), goals).first().is_met


def test_clashing_columns_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 6, None), (None, 1, 7, "y"), ("b", None, 8, "z")], "id string, target_id int, rank int, `_salt` string")
    goals = spark.createDataFrame([(1, 1.0, 0, 30)], "target_id int, target_share double, min_rows int, sample_size int")
    drawn = divisor_sample(df, goals)
    assert drawn.columns == ["id", "target_id", "_salt", "rank", "priority"] and sorted(r["rank"] for r in drawn.collect()) == [1, 2, 3]


def test_found_lines_come_through_the_ranking(spark):
    """The plan of p2_found ranks all records and draws the sample; a plain count would not."""
    from corpusmill.llm.queries_quota import p2_found

    plan = p2_found(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") >= 2 and "_slice" in plan
