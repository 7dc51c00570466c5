"""Payments matched to delayed fraud labels, as a stream and as a batch.

The earliest label that comes no later than ``timeout`` after its payment makes
the payment fraud; a payment without one becomes not fraud when the timeout has
passed. Every other label, further ones of the payment too, is late and changes
nothing. Time is event time, so a rerun gives the same result. The waiting payments
lie in files beside the checkpoint (``waiting``), not in a state store.
"""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import replicate
from tidemark.streaming import waiting
from tidemark.streaming.layers import _trigger, append_micro_batch, run_of
from tidemark.streaming.waiting import DUE

MATCHED, TIMED_OUT, LATE = "matched", "timed_out", "late_label"
ENRICHED = ("src_opening_date", "dest_opening_date", "src_risk_flag", "dest_risk_flag")


def account_profiles(accounts: DataFrame, risk: DataFrame) -> DataFrame:
    """One row per account: opening date and risk flag (0 without one)."""
    flags = risk.groupBy("account_id").agg(F.max("risk_flag").cast("int").alias("risk_flag"))
    both = accounts.select("account_id", "opening_date").join(flags, "account_id", "full")
    return both.withColumn("risk_flag", F.coalesce("risk_flag", F.lit(0)))


def enrich(payments: DataFrame, profiles: DataFrame) -> DataFrame:
    """Payments with opening dates and risk flags of both accounts.

    Works on streams and tables. An unknown account has a null date and flag 0.
    """
    out = payments
    for role in ("src", "dest"):
        side = profiles.select(
            F.col("account_id").alias(f"_{role}"),
            F.col("opening_date").alias(f"{role}_opening_date"),
            F.col("risk_flag").alias(f"{role}_risk_flag"),
        )
        out = out.join(side, F.col(f"{role}_account_id") == F.col(f"_{role}"), "left").drop(f"_{role}")
        out = out.withColumn(f"{role}_risk_flag", F.coalesce(f"{role}_risk_flag", F.lit(0)))
    return out.select(*payments.columns, *ENRICHED)


def start_enrichment(
    payments: DataFrame, load_profiles: Callable[[], DataFrame], path: str, checkpoint: str, interval: str | None = "1 minute"
):
    """Enriched payments into a Parquet folder; the profiles are loaded anew for every micro-batch."""
    run = run_of(payments.sparkSession, checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        append_micro_batch(enrich(batch, load_profiles()), epoch, path, run)

    return (
        payments.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def _in_time(timeout: str):
    limit = F.col("timestamp") + F.expr(f"interval {timeout}")
    return (
        (F.col("payment_id") == F.col("_label_payment"))
        & (F.col("label_ts") >= F.col("timestamp"))
        & (F.col("label_ts") <= limit)
    )


def _label_side(labels: DataFrame) -> DataFrame:
    return labels.select(
        F.col("payment_id").alias("_label_payment"), "fraud_type", "fraud_reported_date", "label_ts"
    )


LABEL = ("label_ts", "fraud_type", "fraud_reported_date")


def _waiting_schema(columns: T.StructType) -> T.StructType:
    return T.StructType([*columns.fields, T.StructField(DUE, T.LongType())])


def _key_schema(payments: T.StructType) -> T.StructType:
    return _waiting_schema(T.StructType([payments["payment_id"], payments["timestamp"]]))


def match_micro_batch(
    payments: DataFrame, labels: DataFrame, epoch: int, root: str, timeout: str, delay: str = "0 seconds", fan: int = 16
) -> DataFrame:
    """Final records that one micro-batch brings; what still waits is kept below ``root``.

    The watermark is the lesser of both sides' greatest moments, less ``delay``.
    Payments and labels before it are complete, so

    - a label before it is decided: of the payments that wait for it, those whose
      earliest label it is are matched; if it is used by none (of equal labels, by
      fewer than there are), it is late;
    - a payment whose deadline lies before it and that has no label has timed out;
    - other labels are kept until the next micro-batch, other payments are written
      once (``waiting``); keys of payments matched later are written beside them.

    A payment or label that comes later than ``delay`` is not lost: it meets what
    still waits. Rows without a time pass at once. A retry gives the same records.
    """
    spark = payments.sparkSession
    before = waiting.read_ledger(spark, root, epoch - 1)
    waiting.remove_unused(spark, root, epoch, before)
    after = waiting.Ledger(dict(before.seen), before.watermark, {k: list(s) for k, s in before.segments.items()})
    moments = [
        df.select(F.lit(side).alias("side"), F.col(moment).cast("timestamp").alias("at"))
        for side, df, moment in (("payments", payments, "timestamp"), ("labels", labels, "label_ts"))
    ]
    latest = F.unix_micros(F.max("at") - F.expr(f"interval {delay}")).alias("latest")
    for side, moment in moments[0].unionByName(moments[1]).filter("at is not null").groupBy("side").agg(latest).collect():
        after.seen[side] = max(moment, after.seen.get(side, moment))
    if len(after.seen) == 2:
        after.watermark = max(before.watermark, min(after.seen.values()))
    reached = F.lit(after.watermark)

    label_at = F.unix_micros(F.col("label_ts").cast("timestamp"))
    side = _label_side(labels.filter("label_ts is not null"))
    kept = waiting.read_segments(spark, after.segments.pop("labels", []), _waiting_schema(side.schema))
    known = side.withColumn(DUE, label_at).unionByName(kept)
    later = waiting.add_segment(known.filter(F.col(DUE) >= reached), root, "labels", epoch, after)
    ready = known.filter(F.col(DUE) < reached).groupBy("_label_payment", *LABEL).agg(F.count("*").alias("_n"))

    due = F.unix_micros((F.col("timestamp") + F.expr(f"interval {timeout}")).cast("timestamp"))
    fresh = payments.filter("timestamp is not null").withColumn(DUE, due)
    schema, keys = _waiting_schema(payments.schema), _key_schema(payments.schema)
    stored = waiting.read_segments(spark, before.segments.get("payments", []), schema)
    settled = waiting.read_segments(spark, before.segments.get("settled", []), keys).select("payment_id", "timestamp")
    open_rows = fresh.unionByName(stored.filter(F.col(DUE) >= before.watermark))

    moments = open_rows.select("payment_id", "timestamp", DUE)
    earliest = F.min(F.struct(*LABEL)).alias("_label")
    found = moments.join(ready, _in_time(timeout)).groupBy("payment_id", "timestamp", DUE).agg(earliest)
    found = waiting.stored_at(found.join(settled, ["payment_id", "timestamp"], "left_anti"), f"{root}/found/{epoch}")
    named = found.select(
        F.col("payment_id").alias("_label_payment"), F.col("timestamp").alias("_label_at"), "_label.*"
    ).withColumnRenamed("label_ts", "_label_ts")
    same = (F.col("payment_id") == F.col("_label_payment")) & (F.col("timestamp") == F.col("_label_at"))
    done = F.col("_label_payment").isNotNull()
    finals = open_rows.join(named, same, "left").filter(done | (F.col(DUE) < reached))
    finals = finals.join(settled, ["payment_id", "timestamp"], "left_anti")

    uses = found.groupBy("payment_id", "_label").agg(F.count("*").alias("_uses"))
    uses = uses.select(F.col("payment_id").alias("_used_id"), "_label", "_uses")
    used = F.col("_label_payment").eqNullSafe(F.col("_used_id")) & F.struct(*LABEL).eqNullSafe(F.col("_label"))
    late = ready.join(uses, used, "left").withColumn("_copies", F.col("_n") - F.coalesce("_uses", F.lit(0)))
    late = late.filter("_copies > 0").select("_label_payment", "fraud_type", "fraud_reported_date", "_copies")
    absent = {f.name: F.lit(None).cast(f.dataType) for f in payments.schema}
    late = replicate(late, "_copies").withColumns(absent)

    # What is neither final nor stored yet waits from now on; only payments that waited need a note that they are done.
    waits = fresh.filter(F.col(DUE) >= reached).join(found, ["payment_id", "timestamp"], "left_anti")
    waiting.add_segment(waits.select(*schema.names), root, "payments", epoch, after)
    waiting.add_segment(found.select(*keys.names), root, "settled", epoch, after)
    waiting.retire(after)
    noted = waiting.read_segments(spark, after.segments.get("settled", []), keys).select("payment_id", "timestamp")
    merge = dict(epoch=epoch, ledger=after, fan=fan)
    waiting.merge_segments(
        spark, root, "payments", schema, still_needed=lambda rows: rows.join(noted, ["payment_id", "timestamp"], "left_anti"), **merge
    )
    waiting.merge_segments(spark, root, "settled", keys, still_needed=lambda rows: rows, **merge)
    waiting.write_ledger(spark, root, epoch, before, after)

    parts = [_final_records(df, payments.columns) for df in (finals, late)]
    return parts[0].unionByName(parts[1]).unionByName(_untimed_payments(payments)).unionByName(_untimed_labels(labels, payments))


def _untimed_payments(payments: DataFrame) -> DataFrame:
    rows = payments.filter("timestamp is null").withColumns(
        {
            "_label_payment": F.lit(None).cast("string"),
            "fraud_type": F.lit(None).cast("string"),
            "fraud_reported_date": F.lit(None).cast("date"),
        }
    )
    return _final_records(rows, payments.columns)


def _untimed_labels(labels: DataFrame, payments: DataFrame) -> DataFrame:
    rows = _label_side(labels.filter("label_ts is null"))
    absent = {f.name: F.lit(None).cast(f.dataType) for f in payments.schema}
    return _final_records(rows.withColumns(absent), payments.columns)


def _final_records(joined: DataFrame, payment_columns) -> DataFrame:
    has_payment, has_label = F.col("payment_id").isNotNull(), F.col("_label_payment").isNotNull()
    outcome = F.when(has_payment & has_label, MATCHED).when(has_payment, TIMED_OUT).otherwise(LATE)
    others = [c for c in payment_columns if c != "payment_id"]
    return joined.select(
        F.coalesce("payment_id", "_label_payment").alias("payment_id"),
        *others,
        F.when(has_payment, has_label).alias("fraud_flag"),
        "fraud_type",
        "fraud_reported_date",
        outcome.alias("outcome"),
    )


def start_label_matching(
    payments: DataFrame,
    labels: DataFrame,
    timeout: str,
    path: str,
    checkpoint: str,
    delay: str = "0 seconds",
    interval: str | None = "1 minute",
    fan: int = 16,
):
    """Final records into a Parquet folder partitioned by outcome, late labels beside the others.

    Both sides may be out of order by ``delay``. The last payments wait until the
    watermark moves on: later events, or a closing event far ahead on both sides,
    release them.
    """
    run = run_of(payments.sparkSession, checkpoint)
    sides = {"payment": payments, "label": labels}
    absent = {name: F.lit(None).cast(df.schema).alias(name) for name, df in sides.items()}
    tagged = [
        df.select(*(F.struct(*df.columns).alias(n) if n == name else absent[n] for n in sides)) for name, df in sides.items()
    ]

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            of = {name: batch.filter(F.col(name).isNotNull()).select(f"{name}.*") for name in sides}
            final = match_micro_batch(of["payment"], of["label"], epoch, f"{checkpoint}/waiting", timeout, delay, fan)
            append_micro_batch(final, epoch, path, run, ["outcome"])
        finally:
            batch.unpersist()

    return (
        tagged[0]
        .unionByName(tagged[1])
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def reconcile_batch(payments: DataFrame, labels: DataFrame, timeout: str) -> DataFrame:
    """The result a finished stream must have, from tables. The earliest label in time counts.

    Labels meet payments in an inner join, where a skewed id can be split on
    either side, and shrink to one per payment before they are joined back.
    """
    keys = payments.select("payment_id", "timestamp")
    earliest = F.min(F.struct("label_ts", "fraud_type", "fraud_reported_date")).alias("_label")
    matched = _label_side(labels).join(keys, _in_time(timeout)).groupBy("payment_id", "timestamp").agg(earliest)
    matched = matched.select(
        F.col("payment_id").alias("_label_payment"), F.col("timestamp").alias("_label_at"), "_label.*"
    )
    same = (F.col("payment_id") == F.col("_label_payment")) & (F.col("timestamp") == F.col("_label_at"))
    return _final_records(payments.join(matched, same, "left"), payments.columns)


def late_labels(payments: DataFrame, labels: DataFrame, timeout: str) -> DataFrame:
    """Labels, from tables, that aren't the earliest in time of a payment.

    Equal labels are counted: one of them can be the earliest, the others are late.
    """
    keys = payments.select("payment_id", "timestamp").distinct()
    earliest = F.min(F.struct(*LABEL)).alias("_label")
    used = _label_side(labels).join(keys, _in_time(timeout)).groupBy("payment_id", "timestamp").agg(earliest)
    used = used.groupBy("payment_id", "_label").agg(F.count("*").alias("_used"))
    counted = labels.groupBy("payment_id", F.struct(*LABEL).alias("_label")).agg(F.count("*").alias("_n"))
    same = (counted["payment_id"] == used["payment_id"]) & counted["_label"].eqNullSafe(used["_label"])
    left = counted.join(used, same, "left").select(
        counted["payment_id"], counted["_label"], (F.col("_n") - F.coalesce("_used", F.lit(0))).alias("_n")
    )
    copies = left.filter("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return copies.select("payment_id", "_label.*").select(*labels.columns)
