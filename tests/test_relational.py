import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import relational as R
from tidemark.operators import series


def test_star_except(spark, frame):
    df = frame([(1, 2, 3)], "field_1 int, Field_2 int, field_3 int")
    assert df.select(*R.star_except(df, ["FIELD_2"])).columns == ["field_1", "field_3"]
    assert df.select(*R.star_except(df, ["field_3"], "p_", "_s")).columns == ["p_field_1_s", "p_Field_2_s"]
    assert R.star_except(df, df.columns) == []


def test_nullcheck_table(frame):
    assert rows(R.nullcheck_table(frame([("", 1), ("a", 2)], "a string, n int"))) == [("a", 2), (None, 1)]


def test_pivot_gives_zero_and_handles_quotes(frame):
    df = frame([("S", "red"), ("S", "blue's"), ("S", "red"), ("M", "red")], "size string, color string")
    got = df.groupBy("size").agg(*R.pivot_columns("color", ["red", "blue's"]))
    assert got.columns == ["size", "red", "blue's"]
    assert rows(got) == [("M", 1, 0), ("S", 2, 1)]
    less = df.groupBy("size").agg(*R.pivot_columns("color", ["c"], cmp="<=", agg="max", prefix="le_"))
    assert rows(less) == [("M", 0), ("S", 1)]


def test_unpivot_keeps_nulls_and_writes_booleans_as_text(frame):
    df = frame([(1, "x", None, True)], "id int, drop_me string, n int, b boolean")
    got = R.unpivot(df, exclude=["id"], remove=["DROP_ME"])
    assert rows(got) == [(1, "b", "true"), (1, "n", None)]
    with pytest.raises(ValueError):
        R.unpivot(df.select("id"), exclude=["id"])


def test_union_relations(frame):
    one = frame([(1, "a")], "id int, name string")
    two = frame([("7", 5)], "id string, favorite_number int")
    got = R.union_relations({"one": one, "two": two})
    assert got.columns == ["_dbt_source_relation", "id", "name", "favorite_number"]
    assert dict(got.dtypes)["id"] == "int"
    assert rows(got) == [("one", 1, "a", None), ("two", 7, None, 5)]
    kept = R.union_relations({"one": one, "two": two}, include=["ID"], source_column_name=None, column_override={"id": "string"})
    assert rows(kept.filter("id <> '1'")) == [("7",)] and dict(kept.dtypes) == {"id": "string"}
    assert rows(R.union_relations({"one": one, "two": two}, where="id > 5", include=["id"])) == [("two", 7)]
    for bad in ({"include": ["id"], "exclude": ["id"]}, {"include": ["nothing"]}):
        with pytest.raises(ValueError):
            R.union_relations({"one": one}, **bad)


def test_relations_by_pattern(spark, frame):
    for day in ("20180101", "20180102", "20180103"):
        frame([(int(day), "play")], "user_id int, event string").createOrReplaceTempView(f"data_events_{day}")
    found = R.relations_by_pattern(spark, "%", "DATA_events_%", exclude="%0103")
    assert list(found) == ["data_events_20180101", "data_events_20180102"]
    assert list(R.relations_by_prefix(spark, "", "data_events_")) == [f"data_events_2018010{i}" for i in (1, 2, 3)]
    with pytest.raises(ValueError):
        R.union_by_pattern(spark, "%", "no_such_table%")


def test_deduplicate_groups_null_keys_and_ranks_nulls_first(frame):
    df = frame([(1, 1), (1, 2), (None, 5), (None, None), (2, None), (2, 3)], "user_id int, version int")
    got = R.deduplicate(df, ["user_id"], [F.col("version").desc_nulls_first()])
    assert rows(got) == [(1, 2), (2, None), (None, None)]


def test_deduplicate_sends_one_row_per_hot_group_and_task(frame):
    plan = R.deduplicate(frame([(1, 1)], "a int, b int"), ["a"], [F.col("b")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit [a" in plan and "Partial" in plan


def test_listagg(frame):
    df = frame([(1, "b", 2), (1, None, 1), (1, "a", 3), (2, None, 1)], "g int, t string, o int")
    full = df.groupBy("g").agg(R.listagg("t", "_", "o").alias("l"))
    assert rows(full) == [(1, "b_a"), (2, None)]
    assert rows(R.listagg_first(df, ["g"], "t", "_", [F.col("o")], 2)) == [(1, "b"), (2, "")]


def test_column_values(spark, frame):
    df = frame([("a", 1), ("b", 1), ("b", 1), (None, 1), ("c", 0)], "field string, ok int")
    assert [r.value for r in R.column_values(df, "field").collect()] == ["b", "a", "c", None]
    assert [r.value for r in R.column_values(df, "field", max_records=1).collect()] == ["b"]
    assert [r.value for r in R.column_values(df, "field", [F.col("value").desc_nulls_last()], where="ok = 1").collect()] == ["b", "a", None]
    assert [r.value for r in R.column_values(None, "field", default=["y"], spark=spark).collect()] == ["y"]
    with pytest.raises(ValueError):
        R.column_values(None, "field")


def test_single_value(frame):
    df = frame([(None, 1)], "a int, b int")
    assert rows(R.single_value(df, 9)) == [(None,)]
    assert rows(R.single_value(df.limit(0), 9)) == [(9,)]


def test_results_as_dict(frame):
    df = frame([(1, "a", True), (2, "b", None)], "col_1 int, col_2 string, col_3 boolean")
    assert R.results_as_dict(df) == {"col_1": (1, 2), "col_2": ("a", "b"), "col_3": (True, None)}
    with pytest.raises(ValueError):
        R.results_as_dict(df, max_rows=1)


def test_set_operations(frame):
    a, b = frame([(1,), (1,), (None,)], "x int"), frame([(None,), (2,)], "x int")
    assert rows(R.intersect_distinct(a, b)) == [(None,)]
    assert rows(R.except_distinct(a, b)) == [(1,)]


def test_group_by_n(frame):
    assert rows(R.group_by_n(frame([(1, 2, 3), (1, 2, 4)], "a int, b int, c int"), 2).count()) == [(1, 2, 2)]


def test_series(spark):
    assert [r[0] for r in series.generate_series(spark, 3).collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)
    days = [r[0] for r in series.date_spine(spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert len(days) == 9 and str(days[-1]) == "2018-01-09 00:00:00"
    assert series.date_spine(spark, "month", "2018-01-31", "2018-04-30").columns == ["date_month"]
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", "2018-01-01", "2018-01-01")


def test_dates_in_range():
    assert series.dates_in_range("20240228", "20240301") == ["20240228", "20240229", "20240301"]
    assert series.dates_in_range("2024-01-01", in_fmt="%Y-%m-%d", out_fmt="%d") == ["01"]
    assert series.partition_range("20240101,20240102") == ["20240101", "20240102"]
    for bad in ("20240102,20240101", "2024-01-01", "20240101,20240102,20240103"):
        with pytest.raises(ValueError):
            series.partition_range(bad)
