"""Hot groups: the cut and stitched results equal the plain ones, and plans split them."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import asof, skew
from tidemark.session import runtime_settings


def neighbours_by_hand(data, ahead):
    """(group, order, adjacent, edge) of each row, nulls greatest."""

    def rank(v):
        return (v is None, v if v is not None else 0)

    out = []
    for g in {g for g, _ in data}:
        values = sorted((v for h, v in data if h == g), key=rank, reverse=not ahead)
        for i, v in enumerate(values):
            last = i == len(values) - 1
            out.append((g, v, None if last else values[i + 1], last))
    return Counter(out)


@pytest.mark.parametrize("ahead", [True, False])
@pytest.mark.parametrize("hot_rows", [1, 5, 40, 10_000])
def test_adjacent_values_match_brute_force(frame, ahead, hot_rows):
    rng = random.Random(hot_rows)
    data = [("hot", rng.choice([None, 7, 7, 7, rng.randrange(50)])) for _ in range(120)]
    data += [(rng.choice(["a", "b", None]), rng.randrange(10)) for _ in range(30)]
    found, collapsed = skew.adjacent_values(frame(data, "g string, v int"), ["g"], ["v"], "v", ahead, hot_rows)
    if collapsed:
        found = skew.replicate(found, "_copies")
    got = Counter((r.g, r.v, r._adjacent, r._edge) for r in found.collect())
    assert got == neighbours_by_hand(data, ahead)


def test_blocks_cut_text_with_a_shared_start_and_equal_first_columns(spark):
    texts = spark.range(20_000).selectExpr("'g' as g", "concat('account_', lpad(id, 12, '0')) as v", "1L as _copies")
    same = spark.range(20_000).selectExpr("'g' as g", "date'2020-01-01' as first", "id as second", "1L as _copies")
    for df, order in ((texts, ["v"]), (same, ["first", "second"])):
        sizes = [r["count"] for r in skew.in_blocks(df, ["g"], order, 10).groupBy("_block").count().collect()]
        assert len(sizes) == 10 and max(sizes) < 2.5 * 2_000


def test_adjacent_text_with_a_shared_start(frame):
    data = [("hot", f"account_{i % 90:08}") for i in range(200)]
    found, _ = skew.adjacent_values(frame(data, "g string, v string"), ["g"], ["v"], "v", True, 20)
    got = Counter((r.g, r.v, r._adjacent, r._edge) for r in skew.replicate(found, "_copies").collect())
    assert got == neighbours_by_hand(data, True)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.one_of(st.none(), st.floats(-50, 50)), min_size=1, max_size=30),
    bounds=st.lists(st.floats(-50, 50), max_size=20, unique=True).map(sorted),
)
def test_block_of_counts_bounds(frame, numbers, bounds):
    df = frame([(n,) for n in numbers], "n double")
    got = [r[0] for r in df.select(skew.block_of(F.col("n"), bounds)).collect()]
    assert got == [len(bounds) + 1 if n is None else sum(b <= n for b in bounds) for n in numbers]


@pytest.mark.parametrize("kind", ["int", "string", "date", "timestamp", "timestamp_ntz", "decimal(20,2)", "boolean"])
def test_as_number_keeps_order(spark, kind):
    values = {
        "int": "array(-5, 0, 3)",
        "string": "array('', 'Z', 'a', 'ab', 'b', 'é')",
        "date": "array(date'1960-01-01', date'1970-01-01', date'2020-05-05')",
        "timestamp": "array(timestamp'1960-01-01', timestamp'2020-05-05 01:02:03')",
        "timestamp_ntz": "array(timestamp_ntz'1960-01-01', timestamp_ntz'2020-05-05 01:02:03')",
        "decimal(20,2)": "array(-1.50, 0, 2.25)",
        "boolean": "array(false, true)",
    }[kind]
    df = spark.sql(f"select posexplode(cast({values} as array<{kind}>)) as (i, v)")
    got = [r[0] for r in df.orderBy("i").select(skew.as_number(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == sorted(got) and len(set(got)) > 1


def test_as_number_rejects_other_types(spark):
    df = spark.sql("select array(1) as v")
    with pytest.raises(TypeError):
        skew.as_number(F.col("v"), df.schema["v"].dataType)


def test_replicate_spreads_copies(frame, monkeypatch):
    monkeypatch.setattr(skew, "COPY_CHUNK", 3)
    got = rows(skew.replicate(frame([("a", 8), ("b", 1), ("c", 3)], "k string, n long"), "n"))
    assert got == [("a",)] * 8 + [("b",)] + [("c",)] * 3


# --- point-in-time join -----------------------------------------------------------

START = datetime(2020, 1, 1)


def _history(rng, key, versions, overlap=False):
    at, out = START, []
    for i in range(versions):
        end = at + timedelta(minutes=rng.randrange(1, 90))
        out.append((key, at, None if i == versions - 1 else end, i % 2 == 0))
        at = end - timedelta(minutes=5) if overlap else end + timedelta(minutes=rng.choice([0, 0, 10]))
    return out


def _matches(facts, history):
    out = Counter()
    for k, t in facts:
        hits = [f for h, a, b, f in history if h == k and k is not None and t is not None and a <= t and (b is None or t < b)]
        for f in hits or [None]:
            out[(k, t, f)] += 1
    return out


@pytest.mark.parametrize("overlap", [False, True])
@pytest.mark.parametrize("long_history", [2, 8, 1000])
def test_asof_join_matches_brute_force(frame, overlap, long_history):
    rng = random.Random(11)
    history = _history(rng, "hot", 150, overlap) + _history(rng, "warm", 12) + _history(rng, "cold", 2)
    facts = [(rng.choice(["hot", "hot", "warm", "cold", "none", None]), START + timedelta(minutes=rng.randrange(-50, 9000))) for _ in range(400)]
    facts += [("hot", h[1]) for h in history[:40]]
    left = frame(facts, "k string, t timestamp_ntz")
    right = frame(history, "hk string, a timestamp_ntz, b timestamp_ntz, f boolean")
    index = asof.index_versions(right, "hk", "a", "b", ["f"], long_history=long_history)
    assert (index.long_keys is not None) == (long_history < 150)
    got = Counter(tuple(r) for r in asof.asof_join(left, index, "k", "t", {"f": "flag"}).collect())
    assert got == _matches(facts, history)


def test_long_histories_do_not_pair_everything(spark, frame):
    """With 2 000 versions and 2 000 facts of one key the join meets far fewer than 4 million pairs."""
    rng = random.Random(3)
    history = _history(rng, "hot", 2000)
    right = frame(history, "hk string, a timestamp_ntz, b timestamp_ntz, f boolean")
    index = asof.index_versions(right, "hk", "a", "b", ["f"], long_history=16)
    per_slice = index.versions.groupBy("_slice").count()
    largest = per_slice.agg(F.max("count")).first()[0]
    total = per_slice.agg(F.sum("count")).first()[0]
    assert largest < 80 and total < 2 * 2000


@pytest.mark.parametrize("overlap", [False, True])
def test_swept_histories_match_brute_force(spark, frame, overlap):
    """One key with far too many versions for its slices, one that overlaps, short ones; ties and repeated facts."""
    rng = random.Random(5)
    history = _history(rng, "hot", 300) + _history(rng, "other", 200, overlap) + _history(rng, "cold", 2)
    history += [("hot", START + timedelta(minutes=9), START + timedelta(minutes=9), True), ("hot", None, None, True)]  # never valid
    keys = ["hot", "hot", "hot", "other", "cold", "none", None]
    facts = [(rng.choice(keys), START + timedelta(minutes=rng.randrange(-50, 9000))) for _ in range(500)]
    facts += [("hot", h[1]) for h in history[:60]] + [("hot", START)] * 40 + [("hot", None), ("other", None)]
    left = frame(facts, "k string, t timestamp_ntz")
    right = frame(history, "hk string, a timestamp_ntz, b timestamp_ntz, f boolean")
    index = asof.index_versions(right, "hk", "a", "b", ["f"], long_history=8, most_slices=4)
    assert {r[0] for r in index.swept_keys.collect()} == ({"hot"} if overlap else {"hot", "other"})
    assert index.versions.filter("_key = 'hot' and _from < _to").isEmpty()
    joined = asof.asof_join(left, index, "k", "t", {"f": "flag"})
    assert joined.columns == ["k", "t", "flag"]
    assert Counter(tuple(r) for r in joined.collect()) == _matches(facts, [h for h in history if h[1] is not None])


def test_a_swept_key_is_dealt_over_blocks(spark, frame, monkeypatch):
    """Facts of one key and one moment are dealt too; each version stands in one place."""
    placed = []
    monkeypatch.setattr(asof, "in_blocks", lambda *given: placed.append(skew.in_blocks(*given)) or placed[-1])
    history = _history(random.Random(1), "hot", 400)
    right = frame(history, "hk string, a timestamp_ntz, b timestamp_ntz, f boolean")
    index = asof.index_versions(right, "hk", "a", "b", ["f"], long_history=8, most_slices=4)
    left = spark.range(0, 20_000, 1, 4).select(F.lit("hot").alias("k"), F.lit(history[200][1]).cast("timestamp_ntz").alias("t"), "id")
    joined = asof.asof_join(left, index, "k", "t", {"f": "flag"})
    assert joined.filter(F.col("flag") == F.lit(history[200][3])).select("id").distinct().count() == joined.count() == 20_000
    per_block = [r[0] for r in placed[0].groupBy("_block").count().select("count").collect()]
    assert sum(per_block) == 20_400 and max(per_block) < 20_400 / 4


def test_known_version_bound_needs_no_count(frame, monkeypatch):
    right = frame([("a", START, None, True)], "hk string, a timestamp_ntz, b timestamp_ntz, f boolean")
    monkeypatch.setattr(asof, "staged", None)
    assert asof.index_versions(right, "hk", "a", "b", ["f"], versions_bound=3).long_keys is None


def test_hot_account_is_split_at_run_time(spark):
    """A third of the payments on one account: the sort-merge join splits that partition."""
    account = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    facts = spark.range(0, 600_000, 1, 16).select(F.col("id"), account.cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
    accounts = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit(True).alias("f"))
    settings_ = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1MB",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1MB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    }
    with runtime_settings(spark, **settings_):
        first = facts.join(accounts, F.col("k") == F.col("a"), "left").drop("a")
        second = first.join(accounts.withColumnRenamed("f", "g"), F.col("k") == F.col("a"), "left").drop("a")
        out = second.groupBy("f", "g").agg(F.count("*").alias("n"), F.max("pad").alias("m"))
        assert [r.n for r in out.collect()] == [600_000]
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
