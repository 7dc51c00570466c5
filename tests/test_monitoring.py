import math
import random
from bisect import bisect_right
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import monitoring as M

T = datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp_ntz, cents long"


def test_quarantine_names_the_rules(frame):
    df = frame([(1, "a"), (-1, None), (None, "b")], "n int, t string")
    good, bad = M.quarantine_split(df, {"positive": F.col("n") > 0, "named": F.col("t").isNotNull()})
    assert rows(good) == [(1, "a")]
    assert sorted((r.n, tuple(r.failed_rules)) for r in bad.collect() if r.n) == [(-1, ("positive", "named"))]
    assert [r.failed_rules for r in bad.collect() if r.n is None] == [["positive"]]


def test_recent_activity_against_all_pairs(frame):
    data = [("hot", T + timedelta(seconds=(i * 7919) % 20_000), i) for i in range(200)]
    data += [("a", T, 1), ("a", T, 1), ("a", T + timedelta(seconds=3_600), 5), ("a", T + timedelta(seconds=7_201), 7)]
    data += [(None, T, 3), ("b", None, 4), ("a", T, None)]
    got = sorted(map(tuple, M.recent_activity(frame(data, SCHEMA), "k", "at", "cents").collect()), key=str)
    want = []
    for k, at, cents in data:
        seen = [c for j, t, c in data if k and at and j == k and t and timedelta(0) <= at - t <= timedelta(hours=1)]
        total = [c for c in seen if c is not None]
        want.append((k, at, cents, len(seen) if seen else None, sum(total) if total else None))
    assert got == sorted(want, key=str)
    assert M.recent_activity(frame([], SCHEMA), "k", "at", "cents").count() == 0


def test_volume_and_drift(frame):
    data = [
        (datetime(2024, 1, 1), 2, False), (datetime(2024, 1, 9), 4, True), (datetime(2024, 1, 9), 9, None),
        (datetime(2024, 2, 1), 8, True), (None, 1, True),
    ]
    df = frame(data, "at timestamp_ntz, cents long, flag boolean")
    assert [tuple(r)[1:] for r in M.volume_check(df, "at").orderBy("period").collect()] == [(3, None, False), (1, 3, True)]
    first, second = M.drift_profile(df, "at", "cents", "flag").orderBy("period").collect()
    assert (first.mean_cents, first.mean_cents_change) == (5.0, None)
    assert (second.mean_cents_change, round(second.flag_share_change, 9)) == (3.0, round(2 / 3, 9))


def test_a_period_without_rows_is_a_drop(frame):
    df = frame([(datetime(2024, m, 3),) for m in (1, 1, 4, 10)], "at timestamp_ntz")
    got = [tuple(r)[1:] for r in M.volume_check(df, "at").orderBy("period").collect()]
    assert got[:5] == [(2, None, False), (0, 2, True), (0, 0, False), (1, 0, False), (0, 1, True)] and len(got) == 10
    assert [r.n_rows for r in M.volume_check(df, "at", "quarter").orderBy("period").collect()] == [2, 1, 0, 1]
    assert M.volume_check(df.limit(0), "at").count() == 0


def test_recent_activity_of_a_hot_hour_keeps_columns_of_any_name(frame):
    rng = random.Random(3)
    data = [("hot", T + timedelta(seconds=rng.randrange(900)), rng.choice([None, 5, 7]), k, k % 3) for k in range(3_000)]
    data += [(f"k{k % 50}", T + timedelta(seconds=rng.randrange(90_000)), k, k, 1) for k in range(1_000)]
    df = frame(data, "key string, at timestamp_ntz, cents long, slice long, n int")
    got = {r.slice: r for r in M.recent_activity(df, "key", "at", "cents").filter("key = 'hot'").collect()}
    assert M.recent_activity(df, "key", "at", "cents").columns == ["key", "at", "cents", "slice", "n", "n_recent", "cents_recent"]
    for key, at, _, k, _ in data[:60]:
        seen = [c for j, t, c, *_ in data if j == key and t <= at]
        assert (got[k].n_recent, got[k].cents_recent) == (len(seen), sum(c for c in seen if c is not None) or None)


def bucket(value):
    shift = max(abs(value).bit_length() - 6, 0) if value else 0
    number = shift * 32 + (abs(value) >> shift)
    return -number if value < 0 else number


def test_value_buckets_rise_with_the_value(frame):
    values = sorted({s * v for s in (1, -1) for v in [*range(200), 2**20, 2**20 + 1, 2**40 - 1, 2**62]})
    got = [r.b for r in frame([(v,) for v in values], "v long").select(F.col("v"), M.value_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert got == [bucket(v) for v in values] == sorted(got)


def test_drift_against_plain_histograms(frame):
    rng = random.Random(7)
    months = {1: [rng.randrange(20_000) for _ in range(300)], 2: [rng.randrange(20_000) for _ in range(200)], 4: [rng.randrange(9_000, 60_000) for _ in range(250)]}
    data = [(datetime(2024, m, rng.randint(1, 28)), v, v % 2 == 0) for m, values in months.items() for v in values]
    data += [(datetime(2024, 2, 1), None, True), (datetime(2023, 12, 5), None, None), (None, 3, True)]
    got = {r.period.month: r for r in M.drift_profile(frame(data, "at timestamp_ntz, cents long, flag boolean"), "at", "cents", "flag").collect()}
    base = sorted(map(bucket, months[1]))
    edges = {}
    for b in sorted(set(base)):
        edges.setdefault(10 * base.index(b) // len(base), b)
    starts, names = list(edges.values()), list(edges)

    def shares(values):
        bins = [names[max(0, bisect_right(starts, bucket(v)) - 1)] for v in values]
        return [(bins.count(k) + 0.5) / (len(values) + 0.5 * len(names)) for k in names]

    for month, values in months.items():
        q, p = shares(months[1]), shares(values)
        assert math.isclose(got[month].psi, sum((x - y) * math.log(x / y) for x, y in zip(p, q)), abs_tol=1e-12)
        mine, at = sorted(map(bucket, values)), {bucket(v) for vs in months.values() for v in vs}
        gap = max(abs(bisect_right(mine, b) / len(mine) - bisect_right(base, b) / len(base)) for b in at)
        assert math.isclose(got[month].largest_gap, gap)
    assert got[1].psi == got[1].largest_gap == 0 and got[4].psi > got[2].psi
    assert (got[3].n_rows, got[3].psi, got[3].mean_cents, got[4].mean_cents_change) == (0, None, None, None)
    assert (got[12].n_rows, got[12].psi, got[2].n_rows) == (1, None, 201)
    nothing = frame([], "at timestamp_ntz, cents long, flag boolean")
    assert M.drift_profile(nothing, "at", "cents", "flag").count() == 0
