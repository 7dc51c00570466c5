import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows, struct
from tidemark.operators import incremental as I
from tidemark.sources import tables
from tidemark.sources.tables import materialize_table, refresh_materialized, replace_partitions, run_incremental

KV = "k int, v string"


@pytest.fixture
def target(frame):
    return frame([(1, "a"), (2, "b"), (None, "n")], KV)


def test_append(target, frame):
    assert len(rows(I.append(target, frame([(1, "z")], KV)))) == 4


def test_delete_insert_keeps_copies_and_null_keys(target, frame):
    batch = frame([(1, "x"), (1, "y"), (None, "m")], KV)
    got = rows(I.delete_insert(target, batch, "k"))
    assert got == [(1, "x"), (1, "y"), (2, "b"), (None, "m"), (None, "n")]
    assert rows(I.delete_insert(target, batch, None)) == rows(I.append(target, batch))
    only = rows(I.delete_insert(target, frame([(1, "x"), (2, "y")], KV), ["k"], ["v = 'a'"]))
    assert only == [(1, "x"), (2, "b"), (2, "y"), (None, "n")]


def test_delete_insert_twice_is_once(target, frame):
    batch = frame([(1, "x"), (3, "c")], KV)
    once = I.delete_insert(target, batch, "k")
    assert rows(I.delete_insert(once, batch, "k")) == rows(once)


def test_merge(target, frame):
    batch = frame([(1, "x"), (3, "c"), (None, "m")], KV)
    once = I.merge(target, batch, "k")
    assert rows(once) == [(1, "x"), (2, "b"), (3, "c"), (None, "m"), (None, "n")]
    keyed = batch.filter("k is not null")
    assert rows(I.merge(I.merge(target, keyed, "k"), keyed, "k")) == rows(I.merge(target, keyed, "k"))
    assert rows(I.merge(target, keyed, None)) == rows(I.append(target, keyed))


def test_merge_sets_nulls(target, frame):
    assert rows(I.merge(target, frame([(1, None)], KV), "k"))[0] == (1, None)


def test_merge_refuses_two_rows_for_one(target, frame):
    with pytest.raises(Exception, match="more than one batch row"):
        I.merge(target, frame([(1, "x"), (1, "y")], KV), "k").collect()
    fresh = I.merge(target, frame([(9, "x"), (9, "y")], KV), "k")
    assert rows(fresh.filter("k = 9")) == [(9, "x"), (9, "y")]


def test_merge_predicates_limit_the_match(target, frame):
    got = I.merge(target, frame([(1, "x"), (2, "y")], KV), "k", ["v <> 'b'"])
    assert rows(got) == [(1, "x"), (2, "b"), (2, "y"), (None, "n")]


def test_merge_columns(frame):
    target = frame([(1, "a", "b")], "k int, v string, w string")
    batch = frame([(1, "x", "y"), (2, "p", "q")], "k int, v string, w string")
    assert rows(I.merge(target, batch, "k", merge_update_columns=["v"])) == [(1, "x", "b"), (2, "p", "q")]
    assert rows(I.merge(target, batch, ["k"], merge_exclude_columns=["V"])) == [(1, "a", "y"), (2, "p", "q")]
    with pytest.raises(ValueError):
        I.merge(target, batch, "k", merge_update_columns=["v"], merge_exclude_columns=["w"])


def test_insert_overwrite(target, frame):
    batch = frame([(7, "x")], KV)
    assert rows(I.insert_overwrite(target, batch)) == [(7, "x")]
    assert rows(I.insert_overwrite(target, batch, ["k = 1"])) == [(2, "b"), (7, "x"), (None, "n")]


def test_microbatch(frame):
    target = frame([(1, "2024-01-01", "a")], "k int, day string, v string")
    batch = frame([(1, "2024-01-02", "b"), (1, "2024-01-03", "c"), (2, "2024-01-09", "d")], "k int, day string, v string")
    got = I.microbatch(target, batch, "k", "day", ["2024-01-02", "2024-01-03", "2024-01-04"])
    assert rows(got) == [(1, "2024-01-03", "c"), (2, "2024-01-09", "d")]
    outlying = frame([(1, None, "n"), (3, None, "m"), (4, "2000-01-01", "e")], "k int, day string, v string")
    edges = ["2024-01-02", "2024-01-03", "2024-01-04"]
    want = [(1, "2024-01-03", "c"), (2, "2024-01-09", "d"), (3, None, "m"), (4, "2000-01-01", "e")]
    assert rows(I.microbatch(target, batch.union(outlying), "k", "day", edges)) == want
    stepwise = I.microbatch(target, batch.union(outlying), "k", "day", edges, store=lambda df: df)
    assert rows(stepwise) == want
    with pytest.raises(ValueError):
        I.microbatch(target, batch, None, "day", ["2024-01-01", "2024-01-02"])


def test_microbatch_reads_its_inputs_equally_often_for_any_number_of_slices(spark, frame, tmp_path):
    for name in ("target", "batch"):
        frame([(1, "2024-01-02", "b")], "k int, day string, v string").write.parquet(str(tmp_path / name))
    target, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "batch"))

    def scans(edges):
        plan = I.microbatch(target, batch, "k", "day", edges)._jdf.queryExecution().sparkPlan().toString()
        return plan.count("FileScan")

    assert scans([f"2024-01-{d:02}" for d in range(2, 20)]) == scans(["2024-01-02", "2024-01-03"])


def test_dispatch(target, frame):
    batch = frame([(1, "x")], KV)
    assert rows(I.apply_strategy(target, batch, None, "k")) == rows(I.delete_insert(target, batch, "k"))
    assert rows(I.apply_strategy(target, batch, "default")) == rows(I.append(target, batch))
    assert rows(I.apply_strategy(target, batch, "merge", "k")) == rows(I.merge(target, batch, "k"))
    with pytest.raises(ValueError):
        I.apply_strategy(target, batch, "magic")


def test_schema_difference():
    old = struct("a int, b string")
    new = struct("a long, c string")
    found = I.diff_schemas(new, old)
    assert [[f.name for f in part] for part in (found.added, found.removed, found.retyped)] == [["c"], ["b"], ["a"]]
    assert not I.diff_schemas(old, old)


def test_schema_change_modes(frame, caplog):
    target = frame([(1, "a")], "k int, v string")
    batch = frame([(2, 5)], "k long, extra int")
    with pytest.raises(ValueError, match="extra"):
        I.reconcile_schema(target, batch, "fail")
    same, columns = I.reconcile_schema(target, batch, "ignore")
    assert same is target and columns == ["k", "v"]
    with caplog.at_level(logging.WARNING):
        assert I.reconcile_schema(target, batch, "whatever")[1] == ["k", "v"]
    assert "whatever" in caplog.text
    wider, columns = I.reconcile_schema(target, batch, "append_new_columns")
    assert rows(I.append(wider, batch, columns)) == [(1, "a", None), (2, None, 5)]
    synced, columns = I.reconcile_schema(target, batch, "sync_all_columns")
    assert dict(synced.dtypes) == {"k": "bigint", "extra": "int"}
    assert rows(I.append(synced, batch, columns)) == [(1, None), (2, 5)]


def test_run_incremental(spark, frame):
    batches = [frame([(1, "a"), (2, "b")], KV), frame([(2, "c"), (3, "d")], KV)]
    seen = []

    def build(current):
        seen.append(None if current is None else current.count())
        return batches[0 if current is None else 1]

    for _ in range(2):
        table = run_incremental(spark, "inc_keyed", build, unique_key="k")
    assert rows(table) == [(1, "a"), (2, "c"), (3, "d")] and seen == [None, 2]
    assert rows(run_incremental(spark, "inc_keyed", build, unique_key="k", full_refresh=True)) == [(1, "a"), (2, "b")]
    for _ in range(2):
        table = run_incremental(spark, "inc_plain", build)
    assert len(rows(table)) == 4
    wider = frame([(3, "d", 1)], "k int, v string, w int")
    got = run_incremental(spark, "inc_plain", lambda current: wider, on_schema_change="append_new_columns")
    assert got.columns == ["k", "v", "w"] and got.filter("w = 1").count() == 1


def test_materialize_reads_the_table_it_replaces(spark, frame):
    materialize_table(frame([(1,)], "n int"), "mat_t")
    table = materialize_table(spark.table("mat_t").select((F.col("n") + 1).alias("n")), "mat_t")
    assert rows(table) == [(2,)]
    with pytest.raises(Exception):
        materialize_table(spark.table("mat_t").select(F.raise_error(F.lit("no")).alias("n")), "mat_t")
    assert rows(spark.table("mat_t")) == [(2,)]
    spark.sql("alter table mat_t rename to mat_t__old")  # a swap that stopped halfway
    assert rows(materialize_table(frame([(3,)], "n int"), "mat_t")) == [(3,)]
    spark.sql("alter table mat_t rename to mat_t__old")
    assert tables.table_exists(spark, "mat_t") and rows(spark.table("mat_t")) == [(3,)]
    assert rows(refresh_materialized(spark, lambda: frame([(5,)], "n int"), "mat_t")) == [(5,)]


def test_replace_partitions(spark, frame):
    materialize_table(frame([(1, "d1"), (2, "d2")], "n int, day string"), "by_day", partition_by=["day"])
    assert rows(spark.table("by_day")) == [(1, "d1"), (2, "d2")]
    assert rows(replace_partitions(frame([(9, "d2")], "n int, day string"), "by_day")) == [(1, "d1"), (9, "d2")]


def test_keyed_strategies_rewrite_only_touched_partitions(spark, frame):
    schema = "k int, v string, day string"
    first = frame([(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3"), (4, "d", "d4")], schema)
    # Key 2 moves to another partition and leaves its old one empty; key 5 opens a new one.
    later = frame([(2, "B", "d3"), (5, "e", "d's")], schema)

    def build(current):
        return first if current is None else later

    for strategy in ("merge", "delete+insert"):
        table = f"parts_{strategy[:5]}"
        run_incremental(spark, table, build, strategy, "k", partition_by=["day"])
        files = {r.day: r.f for r in spark.table(table).select("day", F.input_file_name().alias("f")).collect()}
        got = run_incremental(spark, table, build, strategy, "k", partition_by=["day"])
        assert rows(got.select("k", "v", "day")) == [(1, "a", "d1"), (2, "B", "d3"), (3, "c", "d3"), (4, "d", "d4"), (5, "e", "d's")]
        after = {r.day: r.f for r in got.select("day", F.input_file_name().alias("f")).collect()}
        assert after["d1"] == files["d1"] and after["d4"] == files["d4"] and after["d3"] != files["d3"]
        assert "d2" not in after


def test_overwrite_with_predicates_rewrites_only_touched_partitions(spark, frame):
    schema = "k int, v string, day string"
    first = frame([(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d2"), (4, "d", "d3"), (6, "f", None), (7, "g", "d4")], schema)
    later = frame([(9, "n", "d4"), (10, "n", None)], schema)

    def build(current):
        return first if current is None else later

    def run():
        options = dict(partition_by=["day"], predicates=["k >= 3", "k < 5"])
        return run_incremental(spark, "over_parts", build, "insert_overwrite", **options)

    run()
    files = {r.day: r.f for r in spark.table("over_parts").select("day", F.input_file_name().alias("f")).collect()}
    got = run()
    want = [(1, "a", "d1"), (2, "b", "d2"), (6, "f", None), (7, "g", "d4"), (9, "n", "d4"), (10, "n", None)]
    assert rows(got.select("k", "v", "day")) == sorted(want, key=lambda r: (False, str(r[0])))
    after = {r.day: r.f for r in got.select("day", F.input_file_name().alias("f")).collect()}
    assert after["d1"] == files["d1"] and after["d2"] != files["d2"] and "d3" not in after


def test_many_partitions_are_rewritten_one_by_one(spark):
    def days(first, count, tag):
        return spark.range(first, first + count).selectExpr("id as k", f"'{tag}' as v", "concat('d', id) as day")

    batches = [days(0, 1_300, "a"), days(100, 1_150, "b")]
    for batch in batches:
        got = run_incremental(spark, "many_parts", lambda current: batch, "merge", "k", partition_by=["day"])
    assert got.count() == 1_300 and got.filter("v = 'b'").count() == 1_150
    moved = spark.range(100).selectExpr("id as k", "'c' as v", "cast(null as string) as day")
    got = run_incremental(spark, "many_parts", lambda current: moved, "merge", "k", partition_by=["day"])
    assert got.count() == 1_300 and got.filter("v = 'c' and day is null").count() == 100
    assert got.filter("v = 'a' and day is not null").count() == 50
