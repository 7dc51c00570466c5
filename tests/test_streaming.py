"""Streams from files against the batch form; several runs of one checkpoint move the watermark."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows, struct
from tidemark.schemas import PAYMENT_EVENT
from tidemark.sources import events as E
from tidemark.streaming import labels as L
from tidemark.streaming import layers
from tidemark.streaming.settings import ROCKSDB, stateful_stream
from tidemark.streaming.waiting import read_ledger

MESSAGE = struct("value string")
PAYMENT = struct(
    "payment_id string, src_account_id string, dest_account_id string, amount double, timestamp timestamp"
)
LABEL = struct("payment_id string, fraud_type string, fraud_reported_date date, label_ts timestamp")
T0 = datetime(2024, 5, 1, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def message(i, amount="1.5"):
    return (
        f'{{"transaction_id":"t{i}","user_id":"u","user_name":"U","amount":{amount},"currency":"USD",'
        f'"merchant_id":"m","event_timestamp":"2024-05-01T12:00:0{i}Z"}}',
    )


def test_parse_turns_broken_messages_into_null_rows(frame):
    df = frame([message(1), ("not json",), message(2, '"x"'), ('{"transaction_id":"t3"}',)], "value string")
    got = {r.transaction_id: r for r in E.parse_payment_events(df).collect()}
    assert E.parse_payment_events(df).count() == 4
    assert got["t1"].event_timestamp == at(1) and got["t1"].amount == 1.5
    assert got["t3"].amount is None
    assert all(v is None for v in got[None])


def test_messages_round_trip(frame):
    events = E.parse_payment_events(frame([message(1), message(2)], "value string"))
    assert rows(E.parse_payment_events(E.to_messages(events))) == rows(events)
    assert "2024-05-01T12:00:01.000000Z" in E.to_messages(events).first().value


def test_kafka_options():
    options = E.kafka_options("host:9092", starting_offsets="latest", group="g", **{"maxOffsetsPerTrigger": "5"})
    assert options["subscribe"] == "paymentevents" and options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false" and options["kafka.group.id"] == "g"
    assert options["kafka.request.timeout.ms"] == "60000" and options["maxOffsetsPerTrigger"] == "5"
    assert E.kafka_options("h")["startingOffsets"] == "earliest" and "kafka.group.id" not in E.kafka_options("h")


@pytest.fixture
def feed(spark, tmp_path):
    """Folder of messages with a function that adds a file."""
    folder = str(tmp_path / "messages")

    def add(*messages):
        spark.createDataFrame(list(messages), MESSAGE).coalesce(1).write.mode("append").parquet(folder)
        return E.open_stream(spark, "parquet", {"path": folder}, MESSAGE)

    return add


def test_bronze_and_silver(spark, feed, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    for batch in ([message(1), message(2)], [message(3)]):
        layers.start_bronze_silver(feed(*batch), bronze, silver, checkpoint, interval=None).awaitTermination()
    got = spark.read.parquet(silver)
    assert rows(got.select("transaction_id", "risk_score", "epoch_id")) == [("t1", 0.015, 0), ("t2", 0.015, 0), ("t3", 0.015, 1)]
    stamped = spark.read.parquet(bronze)
    assert stamped.filter("processing_ts is not null").count() == 3 and "risk_score" not in stamped.columns


def test_retry_of_a_micro_batch_adds_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "layer")
    for epoch, data in ((0, [(1,)]), (1, [(2,)]), (1, [(2,)])):
        layers.append_micro_batch(frame(data, "a int"), epoch, path, "run")
    assert rows(spark.read.parquet(path).select("a")) == [(1,), (2,)]


def test_a_new_checkpoint_keeps_the_rows_of_the_old_one(spark, feed, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for name, batch in (("a", [message(1)]), ("b", [message(2), message(3)])):
        stream = feed(*batch)
        layers.start_bronze_silver(stream, bronze, silver, str(tmp_path / name), interval=None).awaitTermination()
    for layer in (bronze, silver):
        assert {r.transaction_id for r in spark.read.parquet(layer).collect()} >= {"t1", "t2", "t3"}
    assert layers.run_of(spark, str(tmp_path / "a")) != layers.run_of(spark, str(tmp_path / "b"))


def test_trigger():
    assert layers._trigger("1 minute") == {"processingTime": "1 minute"}
    assert layers._trigger(None) == {"availableNow": True}


def test_landing_restarts_where_it_stopped(spark, feed, tmp_path):
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    for batch in ([message(1)], [message(2), ("not json",)]):
        layers.start_landing(feed(*batch), path, checkpoint, interval=None).awaitTermination()
    landed = spark.read.parquet(path)
    assert rows(landed.select("transaction_id")) == [("t1",), ("t2",), (None,)]
    assert set(landed.columns) == {*PAYMENT_EVENT.names, "processing_timestamp"}


# --- labels -----------------------------------------------------------------------

PAYMENTS = [
    ("in_time", "a1", "a2", 1.0, at(0)),
    ("at_limit", "a1", "a2", 2.0, at(1)),
    ("too_late", "a1", "a2", 3.0, at(2)),
    ("unlabeled", "a1", "nobody", 4.0, at(3)),
    ("early_label", "a2", "a1", 5.0, at(20)),
    ("no_time", "a2", "a1", 6.0, None),
]
LABELS = [
    ("in_time", "APP Fraud", date(2024, 5, 2), at(2)),
    ("at_limit", "Money Mule", date(2024, 5, 2), at(4)),
    ("too_late", "APP Fraud", date(2024, 5, 2), at(6)),
    ("unknown", "APP Fraud", date(2024, 5, 2), at(3)),
    ("early_label", "APP Fraud", date(2024, 5, 2), at(19)),
    ("no_label_time", "APP Fraud", date(2024, 5, 2), None),
    ("no_time", "APP Fraud", date(2024, 5, 2), at(3)),
]
WANT = {
    "in_time": (True, "APP Fraud", "matched"),
    "at_limit": (True, "Money Mule", "matched"),
    "too_late": (False, None, "timed_out"),
    "unlabeled": (False, None, "timed_out"),
    "early_label": (False, None, "timed_out"),
    "no_time": (False, None, "timed_out"),
}


# Further labels of payments: the first again, a second in time, one before the payment.
SECOND = [
    LABELS[0],
    ("in_time", "Later Label", date(2024, 5, 3), at(3)),
    ("at_limit", "Early", date(2024, 5, 3), at(0)),
    ("early_label", "Earlier", date(2024, 5, 3), at(18)),
]
LATE_IDS = sorted(
    ["at_limit", "early_label", "early_label", "in_time", "in_time", "no_label_time", "no_time", "too_late", "unknown"]
)


def profiles(frame):
    accounts = frame([("a1", date(2022, 1, 15)), ("a2", date(2023, 1, 1))], "account_id string, opening_date date")
    return L.account_profiles(accounts, frame([("a2", 1), ("a2", 0)], "account_id string, risk_flag int"))


def outcome(df):
    return {r.payment_id: (r.fraud_flag, r.fraud_type, r.outcome) for r in df.collect()}


def test_enrich(frame):
    got = {r.payment_id: r for r in L.enrich(frame(PAYMENTS, PAYMENT), profiles(frame)).collect()}
    assert (got["in_time"].src_risk_flag, got["in_time"].dest_risk_flag) == (0, 1)
    assert got["in_time"].src_opening_date == date(2022, 1, 15)
    assert got["unlabeled"].dest_opening_date is None and got["unlabeled"].dest_risk_flag == 0
    assert len(got) == len(PAYMENTS)


def test_reconcile_batch(frame):
    payments, labels = frame(PAYMENTS, PAYMENT), frame(LABELS, LABEL)
    assert outcome(L.reconcile_batch(payments, labels, "3 seconds")) == WANT
    late = {r.payment_id for r in L.late_labels(payments, labels, "3 seconds").collect()}
    assert late == {"too_late", "unknown", "early_label", "no_label_time", "no_time"}
    second = frame(LABELS + SECOND, LABEL)
    assert outcome(L.reconcile_batch(payments, second, "3 seconds")) == WANT
    late = [r.payment_id for r in L.late_labels(payments, second, "3 seconds").collect()]
    assert sorted(late) == LATE_IDS


@pytest.mark.parametrize("large_state", [False, True])
def test_stream_equals_batch(spark, frame, tmp_path, large_state):
    folders = {n: str(tmp_path / n) for n in ("payments", "labels", "final", "checkpoint")}

    def add(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folders[name])

    def run():
        payments = E.open_stream(spark, "parquet", {"path": folders["payments"]}, PAYMENT)
        labels = E.open_stream(spark, "parquet", {"path": folders["labels"]}, LABEL)
        with stateful_stream(spark, 2, large_state):
            if large_state:
                assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
            L.start_label_matching(
                L.enrich(payments, profiles(frame)), labels, "3 seconds", folders["final"], folders["checkpoint"], interval=None
            ).awaitTermination()

    add("payments", PAYMENTS[:2], PAYMENT)
    add("labels", [LABELS[0], SECOND[0], SECOND[2]], LABEL)
    run()
    add("payments", PAYMENTS[2:], PAYMENT)
    add("labels", [SECOND[1], SECOND[3], *LABELS[1:]], LABEL)
    run()
    add("payments", [("end", None, None, None, at(10_000))], PAYMENT)
    add("labels", [("end too", None, None, at(10_000))], LABEL)
    run()
    found = spark.read.schema(
        T.StructType([*PAYMENT.fields, *struct("src_risk_flag int, fraud_flag boolean, fraud_type string, fraud_reported_date date, outcome string").fields])
    ).parquet(folders["final"])
    finals = found.filter("outcome <> 'late_label' and payment_id <> 'end'")
    assert outcome(finals) == WANT and finals.count() == len(WANT)
    late = [r.payment_id for r in found.filter("outcome = 'late_label'").collect()]
    assert sorted(late) == LATE_IDS


def test_repeated_payments_and_labels_stream_equals_batch(spark, frame, tmp_path):
    payments = [
        *[("twice", "a1", "a2", 1.0, at(0))] * 3,
        ("twice", "a1", "a2", 9.0, at(0)),  # the same moment
        *[("none", "a1", "a2", 1.0, at(1))] * 2,
        ("again", "a1", "a2", 1.0, at(0)), ("again", "a1", "a2", 1.0, at(2)),  # a label for each
        *[("shared", "a1", "a2", 1.0, at(k)) for k in range(2)],  # one label for both
        *[("untimed", "a1", "a2", 1.0, None)] * 2,
        (None, "a1", "a2", 1.0, at(1)),
    ]
    labels = [
        ("twice", "A", None, at(2)),
        *[("again", "A", date(2024, 5, 2), at(1))] * 2, ("again", None, None, at(3)),
        ("shared", "A", None, at(2)), ("shared", "B", None, at(2)),
        *[("alone", "A", None, at(1))] * 3,
        *[("untimed", "A", None, None)] * 2,
    ]
    folders = {n: str(tmp_path / n) for n in ("payments", "labels", "final", "checkpoint")}
    closing = [("end", None, None, None, at(10_000))], [("end", None, None, at(10_000))]
    for more, further in ((payments[::2], labels[1::2]), (payments[1::2], labels[::2]), closing):
        frame(more, PAYMENT).coalesce(1).write.mode("append").parquet(folders["payments"])
        frame(further, LABEL).coalesce(1).write.mode("append").parquet(folders["labels"])
        streams = (E.open_stream(spark, "parquet", {"path": folders[n]}, s) for n, s in (("payments", PAYMENT), ("labels", LABEL)))
        with stateful_stream(spark, 2):
            L.start_label_matching(*streams, "3 seconds", folders["final"], folders["checkpoint"], delay="5 seconds", interval=None).awaitTermination()
    found = spark.read.parquet(folders["final"]).filter("payment_id is null or payment_id <> 'end'")
    batch = L.reconcile_batch(frame(payments, PAYMENT), frame(labels, LABEL), "3 seconds")
    of_payment = F.col("src_account_id").isNotNull()
    assert rows(found.filter(of_payment).select(batch.columns)) == rows(batch) and batch.count() == len(payments)
    late = L.late_labels(frame(payments, PAYMENT), frame(labels, LABEL), "3 seconds").drop("label_ts")
    assert rows(found.filter(~of_payment).select(late.columns)) == rows(late)
    assert sorted(r.payment_id for r in late.collect()) == ["again", *["alone"] * 3, "shared", *["untimed"] * 2]


def test_reference_data_is_loaded_for_every_batch(spark, frame, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("payments", "out", "checkpoint"))
    versions = [profiles(frame), profiles(frame).withColumn("risk_flag", F.lit(7))]
    for i, payment in enumerate(PAYMENTS[:2]):
        spark.createDataFrame([payment], PAYMENT).coalesce(1).write.mode("append").parquet(folder)
        stream = E.open_stream(spark, "parquet", {"path": folder}, PAYMENT)
        L.start_enrichment(stream, lambda: versions[i], path, checkpoint, interval=None).awaitTermination()
    got = spark.read.parquet(path)
    assert rows(got.select("payment_id", "src_risk_flag")) == [("at_limit", 7), ("in_time", 0)]


ACTIVITY = struct("k string, moment timestamp, cents long")


def test_recent_activity_stream_equals_the_batch(spark, tmp_path):
    import random

    from tidemark.operators.monitoring import recent_activity
    from tidemark.streaming.activity import recent_activity_stream, start_recent_activity

    rng = random.Random(2)
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))

    def events(first, last, n):
        return [(rng.choice(["hot", "hot", "hot", "a", "b"]), at(rng.randrange(first, last)), rng.choice([None, 3, 8])) for _ in range(n)]

    def run(data):
        spark.createDataFrame(data, ACTIVITY).coalesce(1).write.mode("append").parquet(feed)
        stream = E.open_stream(spark, "parquet", {"path": feed}, ACTIVITY)
        with stateful_stream(spark, 2):
            start_recent_activity(recent_activity_stream(stream, "k", "moment", "cents"), out, checkpoint, interval=None).awaitTermination()

    # Every run starts anew from the checkpoint; rows come out of order within the delay.
    parts = [events(0, 2_000, 150), events(1_500, 6_000, 200), events(5_500, 11_000, 150)]
    odd = [(None, at(5), 1), ("a", None, 1)]
    for part in parts:
        run(part + odd)
    run([("end", at(90_000), 1)])
    late = ("hot", at(100), 1_000_000)
    run([late, ("end", at(180_000), 1)])

    found = spark.read.schema("key string, at long, n_rows long, n_recent long, cents_recent long").parquet(out)
    got = rows(found.filter("key <> 'end'").select("key", "at", "n_recent", "cents_recent"))
    kept = spark.createDataFrame([e for part in parts for e in part], ACTIVITY)
    batch = recent_activity(kept, "k", "moment", "cents")
    want = rows(batch.select("k", F.unix_seconds("moment").alias("at"), "n_recent", "cents_recent").distinct())
    assert got == want
    assert found.filter("key = 'hot'").agg(F.sum("n_rows")).first()[0] == sum(e[0] == "hot" for part in parts for e in part)


class Held:
    """The state of one group, as Spark hands it to a step."""

    exists, get, hasTimedOut, watermark = False, None, False, 0

    def update(self, value):
        self.exists, self.get = True, value

    def remove(self):
        self.exists, self.get = False, None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, moment):
        assert moment >= self.watermark


def test_one_step_answers_all_keys_of_a_bucket():
    import pandas as pd

    from tidemark.streaming.activity import _trailing

    step, state = _trailing(300), Held()

    def run(watermark, *events):
        state.watermark, state.hasTimedOut = watermark * 1_000, not events
        frames = [pd.DataFrame([e], columns=["key", "at", "n", "valued", "cents"]) for e in events]
        found = [tuple(r) for f in step((0,), iter(frames), state) for r in f.astype(object).itertuples(index=False)]
        return sorted((*r[:4], None if r[4] is pd.NA else r[4]) for r in found)

    assert run(0, ("b", 100, 2, 1, 5), ("a", 100, 1, 1, 7), ("a", 100, 1, 0, 0), ("c", 90, 1, 0, 0)) == []
    assert run(150, ("a", 700, 1, 1, 1), ("b", 120, 9, 9, 9)) == [("a", 100, 2, 2, 7), ("b", 100, 2, 2, 5), ("c", 90, 1, 1, None)]
    # An earlier second comes within the delay: it still sees the hour before it.
    assert run(150, ("a", 160, 1, 1, 2), ("d", 160, 1, 1, 4)) == []
    assert run(200) == [("a", 160, 1, 3, 9), ("d", 160, 1, 1, 4)]
    assert run(800) == [("a", 700, 1, 1, 1)]
    assert run(5_000) == [] and not state.exists


def test_quarantine_keeps_every_message_once(spark, feed, tmp_path):
    from tidemark.streaming import quarantine as Q

    good, bad, checkpoint = (str(tmp_path / n) for n in ("good", "bad", "checkpoint"))
    rules = {"amount": F.col("amount") < 5}
    broken = [("not json",), (message(4)[0][:40],), (None,), ("",), ("[]",), (message(5, '"x"')[0],)]
    batches = [[message(1), message(2, "7"), *broken[:2]], [message(3), *broken[2:]]]
    for batch in batches:
        Q.start_quarantine(feed(*batch), rules, good, bad, checkpoint, interval=None).awaitTermination()
    passed, letters = spark.read.parquet(good), spark.read.parquet(bad)
    assert {r.transaction_id for r in passed.collect()} == {"t1", "t3"} and "raw" not in passed.columns
    got = {(r.raw, r.transaction_id, tuple(r.failed_rules)) for r in letters.collect()}
    assert got == {(message(2, "7")[0], "t2", ("amount",)), *((b[0], None, ("parsed",)) for b in broken)}
    assert passed.count() + letters.count() == sum(map(len, batches))

    # An attempt that wrote one folder only, then the retry.
    run = layers.run_of(spark, checkpoint)
    judged = Q.split_messages(spark.createDataFrame([message(6), ("broken",)], MESSAGE), rules)
    layers.append_micro_batch(judged.filter("size(failed_rules) = 0").drop("raw", "failed_rules"), 2, good, run)
    for _ in range(2):
        Q.write_split(judged, 2, good, bad, run)
    assert spark.read.parquet(good).count() == 3 and spark.read.parquet(bad).count() == 8


def test_volume_of_a_stream_equals_the_batch(spark, tmp_path):
    from tidemark.operators.monitoring import volume_check
    from tidemark.streaming import volume as V

    feed, path, checkpoint = (str(tmp_path / n) for n in ("feed", "volume", "checkpoint"))
    schema = "at timestamp, epoch_id int, period string"  # names that the metrics use too
    first = [(datetime(2024, 1, d, 5), 1, "x") for d in (1, 2, 31)] + [(None, None, None)]
    second = [(datetime(2024, 4, 1), 1, "x"), (datetime(2024, 1, 9), 1, "x"), (datetime(2024, 1, 9), 1, "x"), (None, 2, "y")]
    for rows in (first, second):  # the second run goes on under the same checkpoint; two of its rows are late
        spark.createDataFrame(rows, schema).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        V.start_volume(stream, "at", "month", path, checkpoint, interval=None).awaitTermination()

    def so_far():
        return sorted(map(tuple, V.volume_so_far(spark.read.parquet(path)).collect()))

    want = sorted(map(tuple, volume_check(spark.createDataFrame(first + second, schema), "at").collect()))
    assert so_far() == want and [r[1:] for r in want] == [(5, None, False), (0, 5, True), (0, 0, False), (1, 0, False)]
    metrics = spark.read.parquet(path)
    assert metrics.filter("period is null").agg(F.sum("n_rows")).first()[0] == 2
    assert metrics.agg(F.max("latest"), F.min("earliest")).first()[:] == (datetime(2024, 4, 1), datetime(2024, 1, 1, 5))

    # A micro-batch that is tried again counts once.
    run = layers.run_of(spark, checkpoint)
    more = spark.createDataFrame([(datetime(2024, 5, 1), 1, "x")], schema)
    for _ in range(2):
        V.count_micro_batch(more, 7, "at", "month", path, run)
    assert [r[1:] for r in so_far()][-1] == (1, 1, False)
    assert V.volume_so_far(spark.read.parquet(path).limit(0)).count() == 0


# --- waiting payments in files -------------------------------------------------------


def _label_history(seed, n):
    """Payments in order of time, some repeated, and labels up to 60 seconds after them, some of nothing."""
    draw = random.Random(seed)
    payments = [(f"p{draw.randrange(n // 2)}", "a1", "a2", float(k % 3), at(draw.randrange(k, k + 5))) for k in range(n)]
    payments += draw.choices(payments, k=n // 8)
    labels = [(p[0], draw.choice("AB"), None, p[4] + timedelta(seconds=draw.randrange(-5, 60))) for p in draw.choices(payments, k=n // 2)]
    return sorted(payments, key=lambda p: p[4]), sorted(labels, key=lambda x: x[3])


def _micro_batches(frame, tmp_path, payments, labels, timeout, steps, fan, again=()):
    """Records of match_micro_batch over slices of time; the epochs in ``again`` run twice, as after a failure."""
    root, out, ledgers = str(tmp_path / "waiting"), str(tmp_path / "out"), []
    cuts = [at(k * 40) for k in range(steps - 1)]
    slices = list(zip([at(-100), *cuts], [*cuts, at(100_000)], strict=True))
    for epoch, (low, high) in enumerate(slices):
        part = [frame([r for r in side if low <= r[m] < high], s) for side, s, m in ((payments, PAYMENT, 4), (labels, LABEL, 3))]
        for _ in range(2 if epoch in again else 1):
            layers.append_micro_batch(L.match_micro_batch(*part, epoch, root, timeout, fan=fan), epoch, out, "r", ["outcome"])
        ledgers.append(read_ledger(part[0].sparkSession, root, epoch))
    return part[0].sparkSession.read.parquet(out), ledgers, root


def test_micro_batches_equal_the_batch_with_merges_and_retries(spark, frame, tmp_path):
    payments, labels = _label_history(7, 240)
    timeout = "30 seconds"
    closing = ("end", None, None, None, at(90_000)), ("end", None, None, at(90_000))
    found, ledgers, root = _micro_batches(frame, tmp_path, [*payments, closing[0]], [*labels, closing[1]], timeout, 8, 2, (0, 3, 7))
    found = found.filter("payment_id <> 'end'")
    batch = L.reconcile_batch(frame(payments, PAYMENT), frame(labels, LABEL), timeout)
    finals = found.filter("outcome <> 'late_label'").select(batch.columns)
    assert rows(finals) == rows(batch) and {r.outcome for r in batch.collect()} == {"matched", "timed_out"}
    late = L.late_labels(frame(payments, PAYMENT), frame(labels, LABEL), timeout).drop("label_ts")
    assert rows(found.filter("outcome = 'late_label'").select(late.columns)) == rows(late) and late.count() > 0
    # Only the closing payment is left waiting, and files out of use are gone.
    assert all(s.last >= ledgers[-1].watermark for found in ledgers[-1].segments.values() for s in found)
    used = {s.path for ledger in ledgers[-2:] for found in ledger.segments.values() for s in found}
    kept = {os.path.join(root, kind, f) for kind in ("payments", "settled", "labels") for f in os.listdir(os.path.join(root, kind))}
    assert used <= kept
    assert len([k for k in kept if "/payments/" in k]) < 8


def test_segments_in_use_grow_with_the_logarithm(spark, frame, tmp_path):
    payments, labels = _label_history(3, 160)
    _, ledgers, _ = _micro_batches(frame, tmp_path, payments, labels, "9 hours", 5, 2)
    levels = [sorted(s.level for s in ledger.segments.get("payments", [])) for ledger in ledgers]
    assert levels == [[], [0], [1], [0, 1], [2]]  # the first slice holds no payment
    waiting = spark.read.parquet(*[s.path for s in ledgers[-1].segments["payments"]])
    assert waiting.count() <= len(payments)  # matched ones were left out by the merges


def test_late_arrivals_are_not_lost(frame, tmp_path):
    root = str(tmp_path / "waiting")
    first = frame([("p", "a1", "a2", 1.0, at(100))], PAYMENT), frame([("late", "A", None, at(5)), ("x", "A", None, at(100))], LABEL)
    assert outcome(L.match_micro_batch(*first, 0, root, "3 seconds")) == {"late": (None, "A", "late_label")}
    second = frame([("late", "a1", "a2", 1.0, at(4)), ("q", "a1", "a2", 1.0, at(50))], PAYMENT), frame([("q", "A", None, at(51))], LABEL)
    got = outcome(L.match_micro_batch(*second, 1, root, "3 seconds"))
    assert got == {"late": (False, None, "timed_out"), "q": (True, "A", "matched")}


def test_one_silent_side_decides_nothing(frame, tmp_path):
    root, none = str(tmp_path / "waiting"), frame([], LABEL)
    payments = frame(PAYMENTS, PAYMENT)
    assert outcome(L.match_micro_batch(payments, none, 0, root, "3 seconds")) == {"no_time": (False, None, "timed_out")}
    empty = L.match_micro_batch(frame([], PAYMENT), none, 1, root, "3 seconds")
    assert empty.isEmpty()
    last = frame([("z", "A", None, at(500))], LABEL)
    got = outcome(L.match_micro_batch(frame([("end", None, None, None, at(500))], PAYMENT), last, 2, root, "3 seconds"))
    assert got == {k: (False, None, "timed_out") for k in WANT if k != "no_time"}
