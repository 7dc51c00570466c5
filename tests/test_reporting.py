import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows, struct
from tidemark.operators import quality as Q
from tidemark.operators import reporting as P
from tidemark.plans.checks import MART, declared_tests


def test_run_test(frame):
    failing = frame([(1,), (2,), (3,)], "a int")
    assert rows(P.run_test(failing)) == [(3, True, True)]
    assert rows(P.run_test(failing, "sum(a)", "> 5", "> 6")) == [(6, True, False)]
    assert rows(P.run_test(failing, limit=2)) == [(2, True, True)]
    assert rows(P.run_test(failing.limit(0))) == [(0, False, False)]


def test_run_suite(frame):
    tables = {"t": frame([(1, None), (1, 2), (-3, 2)], "a int, b int")}
    tests = [
        P.TableTest("b_null", "t", row_fails=F.col("b").isNull()),
        P.TableTest("b_null_where", "t", row_fails=F.col("b").isNull(), where="a < 0"),
        P.TableTest("positive", "t", row_fails=F.col("a") < 0, severity="warn"),
        P.TableTest("a_unique", "t", failing=lambda ts: Q.unique(ts["t"], "a")),
        P.TableTest("a_unique_where", "t", failing=lambda ts: Q.unique(ts["t"], "a"), where="b = 2"),
    ]
    report = {r.test_name: (r.failures, r.status) for r in P.run_suite(tables, tests).collect()}
    assert report == {
        "b_null": (1, "error"),
        "b_null_where": (0, "pass"),
        "positive": (1, "warn"),
        "a_unique": (1, "error"),
        "a_unique_where": (0, "pass"),
    }


def test_suite_scans_once_for_row_conditions(spark, frame, tmp_path):
    frame([(1, 2)], "a int, b int").write.parquet(str(tmp_path / "t"))
    tables = {"t": spark.read.parquet(str(tmp_path / "t"))}
    tests = [P.TableTest(f"n{c}", "t", row_fails=F.col(c).isNull()) for c in ("a", "b")]
    plan = P.run_suite(tables, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_key_tests_agree_with_the_single_tests(spark, frame, tmp_path):
    own = [(1, "a", 0.0), (1, "b", -0.0), (2, None, None), (3, "b", 2.0), (None, "z", 2.0), (9, "z", 3.0)]
    frame(own, "n int, k string, x double").write.parquet(str(tmp_path / "own"))
    frame([(1, "a", 2.0), (3, None, 0.0), (3, "b", 9.0)], "n int, k string, x double").write.parquet(str(tmp_path / "other"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("own", "other")}
    tests, want = [], {}
    for column in ("n", "k", "x"):
        for where in (None, "n < 3"):
            df = tables["own"].filter(where) if where else tables["own"]
            other, name = tables["other"], f"{column} {where}"
            distinct = [t.filter(f"{column} is not null").select(column).distinct().count() for t in (df, other)]
            for kind, failures in (
                ("unique", Q.unique(df, column).count()),
                ("known", Q.relationships(df, column, other, column).count()),
                ("as_many", int(distinct[0] != distinct[1])),
            ):
                beside = (None, None) if kind == "unique" else ("other", column)
                tests.append(P.TableTest(f"{kind} {name}", "own", keys=P.KeyTest(kind, column, *beside), where=where))
                want[tests[-1].name] = failures
    report = P.run_suite(tables, tests)
    assert {r.test_name: r.failures for r in report.collect()} == want and sum(want.values()) > 5
    planned = P.run_suite(tables, tests)._jdf.queryExecution().executedPlan().toString()  # not run: each scan stands once
    assert planned.count("FileScan") == 2
    empty = {name: t.limit(0) for name, t in tables.items()}
    assert {r.failures for r in P.run_suite(empty, tests).collect()} == {0}
    with pytest.raises(ValueError, match="different types"):
        P.run_suite(tables, [P.TableTest("t", "own", keys=P.KeyTest("known", "n", "other", "k"))])


def test_declared_tests_find_faults(frame):
    mart = frame(
        [("p1", "a1", None, None, "2020-01-01 00:00:00", "2021-01-01", True), ("p1", "a9", True, True, "2022-01-01 00:00:00", "2021-01-01", False)],
        "payment_id string, source_account_id string, source_risk_flag boolean, destination_risk_flag boolean,"
        " timestamp string, source_opening_date string, is_fraud_flag boolean",
    )
    mart = mart.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).withColumn(
        "source_opening_date", F.col("source_opening_date").cast("date")
    )
    tables = {
        MART: mart,
        "stg_payments": frame([("p1", -1.0)], "payment_id string, amount double"),
        "stg_accounts": frame([("a1",)], "account_id string"),
        "stg_risk_feed": frame([(None,)], "account_id string"),
        "stg_fraud_cases": frame([("p1",)], "payment_id string"),
    }
    report = {(r.table_name, r.test_name): r.status for r in P.run_suite(tables, declared_tests()).collect()}
    assert len(report) == 20
    bad = {k for k, status in report.items() if status != "pass"}
    assert bad == {
        (MART, "row_count"),
        (MART, "unique_payment_id"),
        (MART, "relationships_source_account_id"),
        (MART, "is_after_timestamp"),
        (MART, "not_null_source_risk_flag"),
        (MART, "not_null_destination_risk_flag"),
        ("stg_payments", "amount_not_negative"),
        ("stg_risk_feed", "not_null_account_id"),
    }
    assert report[("stg_payments", "amount_not_negative")] == "warn"


def test_store_failures(spark, frame):
    P.store_failures(frame([(1,)], "a int"), "kept_failures")
    P.store_failures(frame([(2,)], "a int"), "kept_failures_view", as_view=True)
    assert rows(spark.table("kept_failures")) == [(1,)] and rows(spark.table("kept_failures_view")) == [(2,)]


@pytest.mark.parametrize(
    "name,now,status",
    [
        ("raw_payments", "2024-01-01 12:00:00", "pass"),
        ("raw_payments", "2024-01-01 12:00:01", "warn"),
        ("raw_payments", "2024-01-02 00:00:01", "error"),
        ("raw_accounts", "2024-01-03 00:00:00", "pass"),
        ("raw_accounts", "2024-01-03 00:00:01", "warn"),
        ("raw_accounts", "2024-01-05 00:00:01", "error"),
    ],
)
def test_source_freshness(frame, name, now, status):
    df = frame([("2024-01-01 00:00:00",), ("2023-01-01 00:00:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert P.source_freshness(name, df, "t", now, P.RAW_FRESHNESS[name]).first().status == status


def test_source_freshness_filter_query_and_empty(frame):
    df = frame([("2024-01-01 00:00:00", 1)], "t string, k int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    now = "2024-01-01 01:00:00"
    assert P.source_freshness("s", df, "t", now, P.Freshness(filter="k = 2")).first().status == "error"
    own = df.select(F.max("t").alias("max_loaded_at"))
    assert P.source_freshness("s", df, "t", now, query=own).first().age_seconds == 3600
    assert P.source_freshness("s", df, "t", "2030-01-01", P.Freshness(None, None)).first().status == "pass"


def test_contract(frame):
    df = frame([(1, "a")], "a int, b string")
    declared = struct("b string, a int")
    assert P.enforce_contract(df, declared).columns == ["b", "a"]
    with pytest.raises(ValueError) as error:
        P.enforce_contract(df, struct("a long, c string, d int"))
    for part in ("2 columns, declared 3", "c: missing", "b: not declared", "a: is int, declared bigint"):
        assert part in str(error.value)
    assert rows(P.columns_match_set(df, ["A", "C"])) == [("B", "table"), ("C", "list")]


def test_unit_fixtures(spark):
    schema = struct("id int, v string, d date")
    given = P.fixture(spark, [{"ID": 1, "v": "x"}, {"v": "y"}], schema)
    assert rows(given) == [(1, "x", None), (None, "y", None)]
    assert P.fixture(spark, [], schema).count() == 0
    with pytest.raises(ValueError, match="nope"):
        P.fixture(spark, [{"nope": 1}], schema)
    expected = given.select("id", "v")
    assert P.fixture_difference(given, expected).count() == 0
    twice = given.union(given.filter("id = 1"))
    assert rows(P.fixture_difference(twice, expected)) == [(1, "x", "actual")]
    assert P.tagged_comparison(given, expected).count() == 4
