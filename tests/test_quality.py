"""Each data test on input that passes and on input that fails."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import quality as Q
from tidemark.operators.reporting import run_test


def failures(df, calc="count(*)"):
    return run_test(df, calc).first().failures


def test_unique(frame):
    assert rows(Q.unique(frame([(1,), (1,), (None,), (None,)], "a int"), "a")) == [(1, 2)]
    assert failures(Q.unique(frame([(1,), (2,)], "a int"), "a")) == 0


def test_not_null(frame):
    assert rows(Q.not_null(frame([(1, 2), (None, 3)], "a int, b int"), "a")) == [(None, 3)]


def test_accepted_values(frame):
    df = frame([("a",), ("b",), ("b",), (None,)], "v string")
    assert rows(Q.accepted_values(df, "v", ["a"])) == [("b", 2)]
    assert failures(Q.accepted_values(df, "v", ["a", "b"])) == 0
    assert rows(Q.not_accepted_values(df, "v", ["b", "z"])) == [("b",)]


def test_relationships(frame):
    child, parent = frame([(1,), (2,), (2,), (None,)], "k int"), frame([(1,), (None,)], "p int")
    assert rows(Q.relationships(child, "k", parent, "p")) == [(2,), (2,)]
    assert failures(Q.relationships(child, "k", frame([(1,), (2,)], "p int"), "p")) == 0
    ones = frame([(1,), (2,), (4,), (None,)], "id int")
    twos = frame([(1,), (2,), (3,)], "id int")
    assert failures(Q.relationships_where(ones, "id", twos, "id", from_condition="id <> 4")) == 0
    assert rows(Q.relationships_where(ones, "id", twos, "id", to_condition="id <> 1")) == [(1, None), (4, None)]


def test_is_after(frame):
    df = frame([(1, 2), (2, 2), (None, 2)], "a int, b int")
    assert rows(Q.is_after(df, "a", "b")) == [(1, 2)]


def test_row_count(frame):
    df = frame([(1,)] * 3, "a int")
    assert rows(Q.row_count(df, 4)) == [(3,)] and rows(Q.row_count(df, 3)) == []


def test_accepted_range(frame):
    df = frame([(i,) for i in range(-1, 12)] + [(None,)], "id int")
    assert failures(Q.accepted_range(df, "id", -1, 11)) == 0
    assert rows(Q.accepted_range(df, "id", -1, inclusive=False)) == [(-1,)]
    assert rows(Q.accepted_range(df, "id", max_value="(select 10)")) == [(11,)]
    assert failures(Q.accepted_range(df, "id")) == 0


def test_at_least_one(frame):
    df = frame([("a", None), ("a", 1), ("b", None)], "field string, value int")
    assert failures(Q.at_least_one(df, "value")) == 0
    assert rows(Q.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert failures(Q.at_least_one(df.filter("field = 'b'"), "value")) == 1
    assert failures(Q.at_least_one(df.limit(0), "value")) == 1


def test_cardinality_equality(frame):
    a, b = frame([(1,), (1,), (None,)], "x int"), frame([(1,), (None,), (None,)], "y int")
    assert rows(Q.cardinality_equality(a, "x", b, "y")) == [(1, 1), (1, 2), (None, 1), (None, 2)]
    assert failures(Q.cardinality_equality(a, "x", a.withColumnRenamed("x", "y"), "y")) == 0


def test_equal_rowcount_ignores_one_sided_groups(frame):
    a, b = frame([(1,), (1,), (2,), (None,)], "g int"), frame([(1,), (3,), (None,)], "g int")
    assert failures(Q.equal_rowcount(a, b), Q.EQUAL_ROWCOUNT_FAILURES) == 1
    grouped = Q.equal_rowcount(a, b, ["g"])
    assert failures(grouped, Q.EQUAL_ROWCOUNT_FAILURES) == 1
    assert grouped.count() == 5  # null groups never meet


def test_fewer_rows_than(frame):
    a, b = frame([(1,)] * 3, "g int"), frame([(1,)] * 4, "g int")
    assert failures(Q.fewer_rows_than(a, b), Q.FEWER_ROWS_FAILURES) == 0
    assert failures(Q.fewer_rows_than(a, a), Q.FEWER_ROWS_FAILURES) == 1
    assert failures(Q.fewer_rows_than(b, a), Q.FEWER_ROWS_FAILURES) == 1
    assert failures(Q.fewer_rows_than(b.union(b), a), Q.FEWER_ROWS_FAILURES) == 5


def test_equality(frame):
    a = frame([(1, 1.004, "x"), (2, None, "y"), (2, None, "y")], "id int, n double, note string")
    b = frame([(1, 1.0041, "z"), (2, None, "q"), (3, 3.0, "r")], "id int, n double, note string")
    assert failures(Q.equality(a, a), Q.EQUALITY_FAILURES) == 0
    assert rows(Q.equality(a, b, exclude_columns=["NOTE"], precision=3)) == [("b_minus_a", 3, pytest.approx(3))]
    found = Q.equality(a, b, compare_columns=["id", "n"])
    assert failures(found, Q.EQUALITY_FAILURES) == 3 + 1
    with pytest.raises(ValueError):
        Q.equality(a, b, ["id"], ["n"])
    with pytest.raises(ValueError):
        Q.equality(a, b.drop("note"))


def test_expression_is_true(frame):
    df = frame([(0.0, 1.0), (1.0, 1.0), (None, 1.0)], "col_a double, col_b double")
    assert rows(Q.expression_is_true(df, "col_a + col_b = 1")) == [(1.0, 1.0)]
    assert failures(Q.expression_is_true(df, "> -1", "col_a")) == 0


def test_not_constant(frame):
    df = frame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None)], "g string, v int")
    assert failures(Q.not_constant(df, "v")) == 0
    assert rows(Q.not_constant(df, "v", ["g"])) == [("a", 1)]
    assert failures(Q.not_constant(df.filter("g = 'c'"), "v")) == 0


def test_not_empty_string(frame):
    df = frame([("",), ("  ",), ("a",), (None,)], "s string")
    assert failures(Q.not_empty_string(df, "s")) == 2
    assert failures(Q.not_empty_string(df, "s", trim_whitespace=False)) == 1


def test_not_null_proportion(frame):
    df = frame([(1, "a"), (None, "a"), (1, "b")], "v int, g string")
    assert failures(Q.not_null_proportion(df, "v", 0.5)) == 0
    assert rows(Q.not_null_proportion(df, "v", 0.6, group_by=["g"])) == [("a", 0.5)]
    assert failures(Q.not_null_proportion(df, "v", 0, 0.6)) == 1


def test_recency(frame):
    df = frame([(datetime(2024, 1, 1, 12), 1), (datetime(2023, 1, 1), 2)], "t timestamp_ntz, g int")
    now = "2024-01-02 11:00:00"
    assert failures(Q.recency(df, "t", "day", 1, now)) == 0
    assert failures(Q.recency(df, "t", "hour", 20, now)) == 1
    assert failures(Q.recency(df, "t", "hour", 20, now, ignore_time_component=True)) == 0
    assert [r.g for r in Q.recency(df, "t", "day", 1, now, group_by=["g"]).collect()] == [2]
    assert failures(Q.recency(df.limit(0), "t", "day", 1, now)) == 0


@pytest.mark.parametrize("hot_rows", [1, 10_000])
def test_sequential_values(frame, hot_rows):
    even = frame([(i, "a") for i in (2, 4, 6)] + [(i, "b") for i in (10, 12, 13)], "v int, g string")
    assert rows(Q.sequential_values(even, "v", 2, group_by=["g"], hot_rows=hot_rows)) == [("b", 13, 12)]
    hours = frame([(datetime(2021, 1, 1, h),) for h in (1, 2, 4, 4)], "t timestamp_ntz")
    got = Q.sequential_values(hours, "t", 1, part="hour", hot_rows=hot_rows)
    four = datetime(2021, 1, 1, 4)
    assert rows(got) == [(four, datetime(2021, 1, 1, 2)), (four, four)]


@pytest.mark.parametrize("hot_rows", [1, 10_000])
@pytest.mark.parametrize(
    "ranges,options,bad",
    [
        ([(1, 2), (2, 3), (5, 6)], {}, 0),
        ([(1, 3), (2, 4)], {}, 1),
        ([(1, 2), (2, 3)], {"gaps": "not_allowed"}, 0),
        ([(1, 2), (3, 4)], {"gaps": "not_allowed"}, 1),
        ([(1, 2), (3, 4)], {"gaps": "required"}, 0),
        ([(1, 2), (2, 4)], {"gaps": "required"}, 1),
        ([(1, 1), (1, 2)], {}, 1),
        ([(1, 1), (1, 2)], {"zero_length_range_allowed": True}, 0),
        ([(3, 2)], {}, 1),
        ([(1, 2), (2, None)], {}, 1),
        ([(None, 2)], {}, 1),
        ([(1, 2)] * 5, {}, 4),
    ],
)
def test_mutually_exclusive_ranges(frame, hot_rows, ranges, options, bad):
    df = frame([(7, a, b) for a, b in ranges], "k int, valid_from int, valid_to int")
    for partition in (None, "k"):
        got = Q.mutually_exclusive_ranges(df, "valid_from", "valid_to", partition, hot_rows=hot_rows, **options)
        assert got.count() == bad


def test_mutually_exclusive_ranges_rejects_unknown_gap_rule(frame):
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(frame([(1, 2)], "a int, b int"), "a", "b", gaps="some")


def test_unique_combination(frame):
    df = frame([(1, None), (1, None), (2, 3)], "m int, p int")
    assert rows(Q.unique_combination(df, ["m", "p"])) == [(1, None)]


def test_assert_equal(frame):
    df = frame([(1, 1), (1, 2), (None, 1)], "actual int, expected int")
    assert rows(Q.assert_equal(df, "actual", "expected")) == [(1, 2)]


def test_fraud_counts_match(frame):
    mart = frame([("p1", True), ("p1", True), ("p2", False)], "payment_id string, is_fraud_flag boolean")
    assert rows(Q.fraud_counts_match(mart, frame([("p1",)], "payment_id string"))) == []
    assert rows(Q.fraud_counts_match(mart, frame([("p1",), ("p3",)], "payment_id string"))) == [(1, 2)]
    assert rows(Q.fraud_counts_match(mart.limit(0), frame([("p1",)], "payment_id string"))) == [(0, 1)]


def test_counts_do_not_need_a_cross_join(frame):
    mart = frame([("p1", True)], "payment_id string, is_fraud_flag boolean")
    plan = Q.fraud_counts_match(mart, mart)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Cross" not in plan


def test_where_goes_before_the_test(frame):
    df = frame([(1, 1), (1, 2)], "a int, b int")
    assert failures(Q.unique(df.filter(F.col("b") > 1), "a")) == 0
