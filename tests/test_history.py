from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import names as N
from tidemark.operators import history as H
from tidemark.operators.quality import mutually_exclusive_ranges
from tidemark.plans import risk
from tidemark.sources import tables

T1, T2, T3, T4 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))
CHECK = H.HistoryRules(keys=("id",), check=("v",))


def versions(df, *columns):
    return rows(df.select(*(columns or ("id", "v", N.VALID_FROM, N.VALID_TO))))


def test_first_snapshot_is_open(frame):
    got = H.snapshot(None, frame([(1, "a")], "id int, v string"), CHECK, T1)
    assert versions(got) == [(1, "a", T1, None)]
    assert got.columns == ["id", "v", N.SCD_ID, N.UPDATED_AT, N.VALID_FROM, N.VALID_TO]


def test_check_strategy_cases(frame):
    """New, unchanged, changed, to null, from null, missing; then a second run changes nothing."""
    first = H.snapshot(None, frame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "e")], "id int, v string"), CHECK, T1)
    source = frame([(1, "a"), (2, "B"), (3, None), (4, "d"), (6, "f")], "id int, v string")
    second = H.snapshot(first, source, CHECK, T2)
    assert versions(second) == [
        (1, "a", T1, None),
        (2, "B", T2, None),
        (2, "b", T1, T2),
        (3, "c", T1, T2),
        (3, None, T2, None),
        (4, "d", T2, None),
        (4, None, T1, T2),
        (5, "e", T1, None),
        (6, "f", T2, None),
    ]
    again = H.snapshot(second, source, CHECK, T3)
    assert versions(again) == versions(second)
    assert H.stage_changes(second, source, CHECK, T3).count() == 0
    ends = second.withColumn("e", F.coalesce(N.VALID_TO, F.lit("9999-12-31").cast("timestamp_ntz")))
    assert mutually_exclusive_ranges(ends, N.VALID_FROM, "e", "id", gaps="not_allowed").count() == 0


def test_update_row_carries_the_old_id_and_the_new_start(frame):
    first = H.snapshot(None, frame([(1, "a")], "id int, v string"), CHECK, T1)
    changes = H.stage_changes(first, frame([(1, "b")], "id int, v string"), CHECK, T2)
    by_kind = {r[N.CHANGE_TYPE]: r for r in changes.collect()}
    assert by_kind["update"][N.SCD_ID] == first.first()[N.SCD_ID]
    assert by_kind["update"][N.VALID_TO] == by_kind["insert"][N.VALID_FROM] == T2
    assert by_kind["insert"][N.SCD_ID] != by_kind["update"][N.SCD_ID]


def test_timestamp_strategy(frame):
    rules = H.HistoryRules(keys=("id",), updated_at="at")
    schema = "id int, v string, at timestamp_ntz"
    first = H.snapshot(None, frame([(1, "a", T1), (2, "b", T2)], schema), rules, T4)
    second = H.snapshot(first, frame([(1, "x", T3), (2, "ignored", T2), (3, "n", T1)], schema), rules, T4)
    assert versions(second) == [(1, "a", T1, T3), (1, "x", T3, None), (2, "b", T2, None), (3, "n", T1, None)]


@pytest.mark.parametrize("mode", H.HARD_DELETE_MODES)
def test_hard_deletes(frame, mode):
    rules = H.HistoryRules(keys=("id",), check=("v",), hard_deletes=mode)
    first = H.snapshot(None, frame([(1, "a"), (2, "b")], "id int, v string"), rules, T1)
    second = H.snapshot(first, frame([(2, "b")], "id int, v string"), rules, T2)
    gone = versions(second.filter("id = 1"))
    if mode == "ignore":
        assert gone == [(1, "a", T1, None)]
    elif mode == "invalidate":
        assert gone == [(1, "a", T1, T2)]
        back = H.snapshot(second, frame([(1, "a"), (2, "b")], "id int, v string"), rules, T3)
        assert versions(back.filter("id = 1")) == [(1, "a", T1, T2), (1, "a", T3, None)]
    else:
        flags = versions(second.filter("id = 1"), "v", N.VALID_FROM, N.VALID_TO, N.IS_DELETED)
        assert flags == [("a", T1, T2, "False"), ("a", T2, None, "True")]
        back = H.snapshot(second, frame([(1, "z"), (2, "b")], "id int, v string"), rules, T3)
        assert versions(back.filter("id = 1"), "v", N.VALID_FROM, N.VALID_TO, N.IS_DELETED) == [
            ("a", T1, T2, "False"),
            ("a", T2, T3, "True"),
            ("z", T3, None, "False"),
        ]


def test_null_keys_never_match(frame):
    rules = H.HistoryRules(keys=("id",), check=("v",), hard_deletes="invalidate")
    first = H.snapshot(None, frame([(None, "a")], "id int, v string"), rules, T1)
    second = H.snapshot(first, frame([(None, "a")], "id int, v string"), rules, T2)
    assert versions(second) == [(None, "a", T1, T2), (None, "a", T2, None)]


def test_composite_key_with_a_null_part(frame):
    rules = H.HistoryRules(keys=("a", "b"), check=("v",))
    schema = "a int, b int, v string"
    first = H.snapshot(None, frame([(1, 1, "x"), (1, 2, "y"), (1, None, "z")], schema), rules, T1)
    second = H.snapshot(first, frame([(1, 1, "X"), (1, 2, "y"), (1, None, "z")], schema), rules, T2)
    got = Counter((r.a, r.b, r.v) for r in second.collect())
    assert got == Counter({(1, 1, "x"): 1, (1, 1, "X"): 1, (1, 2, "y"): 1, (1, None, "z"): 2})


def test_renamed_columns_fixed_end_and_new_source_column(frame):
    rules = H.HistoryRules(
        keys=("id",),
        check=("v",),
        open_until="9999-12-31 00:00:00",
        renamed={N.VALID_FROM: "since", N.VALID_TO: "until", N.SCD_ID: "version_id"},
    )
    first = H.snapshot(None, frame([(1, "a"), (2, "b")], "id int, v string"), rules, T1)
    second = H.snapshot(first, frame([(1, "A", 5), (2, "b", 6)], "id int, v string, extra int"), rules, T2)
    end = datetime(9999, 12, 31)
    assert versions(second, "id", "v", "since", "until", "extra") == [
        (1, "A", T2, end, 5),
        (1, "a", T1, T2, None),
        (2, "b", T1, end, None),
    ]
    assert "version_id" in second.columns and N.SCD_ID not in second.columns


def test_new_check_column_changes_every_row(frame):
    rules = H.HistoryRules(keys=("id",), check="all")
    first = H.snapshot(None, frame([(1, "a"), (2, "b")], "id int, v string"), rules, T1)
    second = H.snapshot(first, frame([(1, "a", 1), (2, "b", 2)], "id int, v string, w int"), rules, T2)
    assert second.filter(F.col(N.VALID_TO).isNull()).count() == 2 and second.count() == 4


def test_closed_rows_pass_without_a_join(frame):
    """Only open rows meet the change set: the closed branch is a filter of the target."""
    first = H.snapshot(None, frame([(1, "a")], "id int, v string"), CHECK, T1)
    second = H.snapshot(first, frame([(1, "b")], "id int, v string"), CHECK, T2)
    third = H.snapshot(second, frame([(1, "c")], "id int, v string"), CHECK, T3)
    assert versions(third) == [(1, "a", T1, T2), (1, "b", T2, T3), (1, "c", T3, None)]


def test_rules_are_checked():
    for bad in ({"check": ("v",), "hard_deletes": "maybe"}, {}, {"check": ()}):
        with pytest.raises(ValueError):
            H.HistoryRules(keys=("id",), **bad)


def test_risk_flagging(frame):
    df = frame([("a", 70.0), ("b", 70.1), ("c", None)], "account_id string, risk_score double")
    assert rows(risk.risk_flagging(df)) == [
        ("a", 70.0, False, "Low Risk"),
        ("b", 70.1, True, "High Risk"),
        ("c", None, None, "Low Risk"),
    ]


def test_stored_history_leaves_closed_partitions_alone(spark, frame):
    rules = H.HistoryRules(keys=("id",), check=("v",), hard_deletes="invalidate")
    loads = [(T1, [(1, "a"), (2, "b")]), (T2, [(1, "A"), (2, "b")]), (T3, [(1, "A"), (2, "B")])]
    expected, files = None, {}
    for as_of, data in loads:
        source = frame(data, "id int, v string")
        expected = H.snapshot(expected, source, rules, as_of)
        got = tables.run_snapshot(spark, "stored_history", source, rules, as_of)
        assert versions(got) == versions(expected)
        now = {r[tables.CLOSED_IN]: r.f for r in spark.table("stored_history").select(tables.CLOSED_IN, F.input_file_name().alias("f")).collect()}
        assert all(now[p] == f for p, f in files.items() if p != tables.OPEN)
        files = now
    assert set(files) == {tables.OPEN, str(T2), str(T3)}
    # The same run again, a new column, and a source that loses every key.
    assert versions(tables.run_snapshot(spark, "stored_history", source, rules, T3)) == versions(expected)
    # A second run of the same time that closes another row keeps the first one's rows.
    source = frame([(1, "AA"), (2, "B")], "id int, v string")
    expected = H.snapshot(expected, source, rules, T3)
    assert versions(tables.run_snapshot(spark, "stored_history", source, rules, T3)) == versions(expected)
    wider = frame([(1, "AA", 5), (2, "B", 6)], "id int, v string, w int")
    assert versions(tables.run_snapshot(spark, "stored_history", wider, rules, T4)) == versions(expected)
    gone = tables.run_snapshot(spark, "stored_history", wider.limit(0), rules, T4)
    assert gone.filter(F.col(N.VALID_TO).isNull()).count() == 0 and gone.count() == 5


def test_deletion_records_are_made_once_and_end_when_the_key_returns(frame):
    rules = H.HistoryRules(keys=("id",), check=("v",), hard_deletes="new_record")
    full, without = frame([(1, "a"), (2, "b")], "id int, v string"), frame([(2, "b")], "id int, v string")
    kept = H.snapshot(None, full, rules, T1)
    for moment in (T2, T3):
        kept = H.snapshot(kept, without, rules, moment)
    flag = rules.meta(N.IS_DELETED)
    columns = ("id", "v", N.VALID_FROM, N.VALID_TO, flag)
    want = [(1, "a", T1, T2, "False"), (1, "a", T2, None, "True"), (2, "b", T1, None, "False")]
    assert versions(kept, *columns) == want
    back = H.snapshot(kept, full, rules, T4)
    assert versions(back, *columns) == [want[0], (1, "a", T2, T4, "True"), (1, "a", T4, None, "False"), want[2]]
