from datetime import date, datetime

import pytest

from conftest import rows
from tidemark import schemas, session
from tidemark.functions.sql_functions import create_sql_function
from tidemark.operators.quality import fraud_counts_match
from tidemark.plans import batch
from tidemark.sources import files, jdbc


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_cells_that_do_not_parse_are_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", "payment_id,is_fraud,fraud_type,fraud_reported_date\np1,true,,2024-01-02\np2,maybe,x,never\n")
    assert rows(files.load_csv_typed(spark, path, schemas.RAW_FRAUD_CASES)) == [
        ("p1", True, None, date(2024, 1, 2)),
        ("p2", None, "x", None),
    ]


def land(tmp_path):
    write(tmp_path / "payment_transactions.csv", "payment_id,source_account_id,destination_account_id,payment_reference,amount,payment_timestamp\np1,a1,a2,r,5.5,2024-01-02 03:04:05\n")
    write(tmp_path / "account_details.csv", "account_id,opening_date\na1,2020-01-01\na2,2021-01-01\n")
    write(tmp_path / "risk_feed.csv", "account_id,risk_score\na1,80\n")
    write(tmp_path / "fraud_cases.csv", "payment_id,is_fraud,fraud_type,fraud_reported_date\np1,true,APP Fraud,2024-02-01\n")


def test_consolidate_and_whole_batch(spark, tmp_path):
    land(tmp_path)
    raw = {}

    def store(df, table):
        raw[table] = df
        return df

    counts = files.consolidate_batch(spark, str(tmp_path), store)
    assert counts == {"raw_payments": 1, "raw_accounts": 2, "raw_risk_feed": 1, "raw_fraud_cases": 1}
    with pytest.raises(RuntimeError, match="row_count"):
        batch.run_batch(spark, raw, "2024-01-01 00:00:00", "whole_")
    report = spark.table("whole_" + batch.REPORT)
    assert {r.test_name for r in report.collect() if r.status != "pass"} == {"row_count"}
    mart = spark.table("whole_" + batch.MART).first()
    assert mart.source_risk_flag is True and mart.destination_risk_flag is False and mart.is_fraud_flag is True
    assert mart.timestamp == datetime(2024, 1, 2, 3, 4, 5)
    # A later run of an unchanged feed leaves the history as it is; the date window cuts the mart.
    landed = batch.load_raw(spark, str(tmp_path), "whole_")
    batch.run_batch(spark, landed, "2024-03-01 00:00:00", "whole_", "2025-01-01", "2026-01-01", stop_on_error=False)
    assert spark.table("whole_" + batch.HISTORY).count() == 1
    assert spark.table("whole_" + batch.MART).count() == 0
    assert fraud_counts_match(spark.table("whole_" + batch.MART), spark.table("whole_stg_fraud_cases")).count() == 1


def test_missing_file_ends_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.consolidate_batch(spark, str(tmp_path), lambda df, table: df)


def test_seed(spark, tmp_path):
    path = write(tmp_path / "s.csv", "id,code,name\n1,007,a\n2,,\n")
    seed = files.load_seed(spark, path, {"CODE": "string"})
    assert dict(seed.dtypes) == {"id": "int", "code": "string", "name": "string"}
    assert rows(seed) == [(1, "007", "a"), (2, None, None)]
    assert rows(files.reload_seed(spark, seed, "seed_t")) == rows(seed)
    assert rows(files.reload_seed(spark, seed.filter("id = 2"), "seed_t")) == [(2, None, None)]
    assert files.reload_seed(spark, seed.drop("name"), "seed_t", full_refresh=True).columns == ["id", "code"]


class _Calls:
    """Stands in for the JDBC endpoints of a session; no database is started."""

    def __init__(self, plain=None):
        self.made, self.plain, self.write, self.read = [], plain, self, self

    def repartition(self, n):
        self.made.append(("repartition", n))
        return self

    def jdbc(self, **options):
        self.made.append(options)
        return self.plain


def test_jdbc_write_overwrites_with_few_connections():
    calls = _Calls()
    jdbc.write_jdbc(calls, "jdbc:x", "t", {"user": "u"}, connections=3)
    assert calls.made == [("repartition", 3), {"url": "jdbc:x", "table": "t", "mode": "overwrite", "properties": {"user": "u"}}]


def test_jdbc_read_splits_by_the_range_of_a_column(spark):
    calls = _Calls(spark.sql("select 5 as low, 14 as high"))
    jdbc.read_jdbc(calls, "jdbc:x", "t", {}, split_column="id", partitions=4)
    first, last = calls.made
    assert first["table"] == "(select min(id) as low, max(id) as high from t) bounds"
    assert (last["lowerBound"], last["upperBound"], last["numPartitions"], last["column"]) == ("5", "14", 4, "id")
    calls = _Calls(spark.sql("select null as low, null as high"))
    jdbc.read_jdbc(calls, "jdbc:x", "t", {}, split_column="id")
    assert calls.made[-1] == {"url": "jdbc:x", "table": "t", "properties": {}}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "local-cluster[2,1,1024]"

    class Session:
        conf, sparkContext = {}, Cluster()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Session())
    Cluster.master = "local[2]"
    assert session.shared_folder(Session())


def test_sql_function(spark):
    create_sql_function(spark, "plus_rate", {"x": "double", "r": "double"}, "double", "x * (1 + r)")
    create_sql_function(spark, "plus_rate", {"x": "double", "r": "double"}, "double", "x * (2 + r)")
    assert spark.sql("select plus_rate(2.0D, 0.5D) as v").first().v == 5.0
