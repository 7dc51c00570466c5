"""Rebuilding a window of a stored, partitioned mart."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans import batch

MART = "payment_id string, amount double, timestamp timestamp_ntz"
T0 = datetime(2024, 3, 1)


def payments(step, price, hours=240):
    return [(f"p{h}", price, T0 + timedelta(hours=h)) for h in range(0, hours, step)] + [("none", 1.0, None)]


@pytest.fixture
def mart(spark, frame, tmp_path):
    name = f"mart_{tmp_path.name.replace('-', '_')}"
    batch.store_mart(frame(payments(5, 1.0), MART), name, "day", str(tmp_path))
    yield name
    spark.sql(f"drop table if exists {name}")


def files(spark, table):
    return {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table(table).inputFiles()}


def built(frame, data):
    def build(start, end):
        return frame(data, MART).filter(f"timestamp >= timestamp_ntz'{start}' and timestamp < timestamp_ntz'{end}'")

    return build


@pytest.mark.parametrize("start, end", [("2024-03-03", "2024-03-05"), ("2024-03-02 07:00:00", "2024-03-04 11:30:00")])
def test_only_the_windows_days_are_rewritten(spark, frame, mart, start, end):
    before = files(spark, mart)
    low, high = (datetime.fromisoformat(t) for t in (start, end))
    fresh = payments(3, 2.0)
    got = batch.date_range_rebuild(spark, mart, built(frame, fresh), start, end)
    inside = [r for r in fresh if r[2] and low <= r[2] < high]
    outside = [r for r in payments(5, 1.0) if not (r[2] and low <= r[2] < high)]
    assert rows(got.drop(batch.PERIOD)) == rows(frame(inside + outside, MART))

    after = files(spark, mart)
    days = {f"{batch.PERIOD}={low.date() + timedelta(days=k)}" for k in range((high - timedelta(microseconds=1) - low).days + 2)}
    days = {d for d in days if d <= f"{batch.PERIOD}={(high - timedelta(microseconds=1)).date()}"}
    for path in before.keys() | after.keys():
        day = path.split("/")[-2]
        assert (before.get(path) == after.get(path)) == (day not in days), day
    again = batch.date_range_rebuild(spark, mart, built(frame, fresh), start, end)
    assert rows(again) == rows(got)


def test_the_scan_lists_only_the_windows_partitions(spark, mart):
    window = batch.stored_window(spark, mart, "2024-03-03", "2024-03-05")
    assert {f.split("/")[-2] for f in window.inputFiles()} == {f"{batch.PERIOD}=2024-03-0{d}" for d in (3, 4)}
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(payment_period" in plan and "PushedFilters: []" in plan


def test_a_day_without_payments_goes_and_an_empty_window_changes_nothing(spark, frame, mart):
    batch.date_range_rebuild(spark, mart, built(frame, []), "2024-03-03", "2024-03-04")
    left = {r[0] for r in spark.table(mart).select(F.col(batch.PERIOD).cast("string")).distinct().collect()}
    assert "2024-03-03" not in left and {"2024-03-02", "2024-03-04", None} <= left
    before = files(spark, mart)
    batch.date_range_rebuild(spark, mart, built(frame, payments(1, 9.0)), "2024-03-05", "2024-03-05")
    assert files(spark, mart) == before
