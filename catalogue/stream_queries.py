"""Streams over the test tables: file source, everything available, then stop."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.monitoring_queries import VOLUME_BY_MONTH
from catalogue.registry import query
from catalogue.source_queries import BOTH_LAYERS, both_layers
from tidemark.plans.risk import risk_flagging
from tidemark.session import fresh_folder
from tidemark.sources.events import open_stream, to_messages
from tidemark.streaming import labels as L
from tidemark.streaming.activity import recent_activity_stream, start_recent_activity
from tidemark.streaming.layers import start_bronze_silver, start_landing
from tidemark.streaming.quarantine import start_quarantine
from tidemark.streaming.settings import stateful_stream
from tidemark.streaming.volume import start_volume, volume_so_far

TIMEOUT = "60 days"
MESSAGE = T.StructType([T.StructField("value", T.StringType(), True)])


def _messages(v):
    folder = fresh_folder(v.spark, "messages")
    to_messages(v.payment_events).write.parquet(folder)
    return open_stream(v.spark, "parquet", {"path": folder, "maxFilesPerTrigger": "4"}, MESSAGE)


def _events(df):
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query("stream_bronze_silver", BOTH_LAYERS, "payment_events")
def stream_bronze_silver(v):
    bronze, silver, checkpoint = (fresh_folder(v.spark, n) for n in ("bronze", "silver", "checkpoint"))
    start_bronze_silver(_messages(v), bronze, silver, checkpoint, interval=None).awaitTermination()
    return _events(both_layers(v.spark, bronze, silver))


@query("stream_landing", "select * from payment_events", "payment_events")
def stream_landing(v):
    path, checkpoint = fresh_folder(v.spark, "landing"), fresh_folder(v.spark, "checkpoint")
    start_landing(_messages(v), path, checkpoint, interval=None).awaitTermination()
    return _events(v.spark.read.parquet(path).drop("processing_timestamp"))


def _payments(v):
    return v.payments.select(
        "payment_id",
        F.col("source_account_id").alias("src_account_id"),
        F.col("destination_account_id").alias("dest_account_id"),
        "amount",
        F.col("payment_timestamp").cast("timestamp").alias("timestamp"),
    )


def _labels(v):
    moment = F.col("fraud_reported_date").cast("timestamp").alias("label_ts")
    return v.fraud_cases.select("payment_id", "fraud_type", "fraud_reported_date", moment)


def _profiles(v):
    flags = risk_flagging(v.risk_feed_v1).select("account_id", F.col("risk_flag").cast("int").alias("risk_flag"))
    return L.account_profiles(v.accounts, flags)


def _plain(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


_ENRICHED = """select p.payment_id, p.source_account_id as src_account_id, p.destination_account_id as dest_account_id, p.amount,
       p.payment_timestamp as timestamp, sa.opening_date as src_opening_date, da.opening_date as dest_opening_date,
       cast(coalesce(sr.risk_score > 70, false) as integer) as src_risk_flag,
       cast(coalesce(dr.risk_score > 70, false) as integer) as dest_risk_flag
  from payments p left join accounts sa on p.source_account_id = sa.account_id
  left join accounts da on p.destination_account_id = da.account_id
  left join risk_feed_v1 sr on p.source_account_id = sr.account_id
  left join risk_feed_v1 dr on p.destination_account_id = dr.account_id"""
_ENRICHED_VIEWS = "payments accounts risk_feed_v1"
_FINAL = f"""with enriched as ({_ENRICHED}),
  labels as (select payment_id, fraud_type, fraud_reported_date, cast(fraud_reported_date as timestamp) as label_ts from fraud_cases),
  final as (select e.*, l.payment_id is not null as fraud_flag, l.fraud_type, l.fraud_reported_date,
                   case when l.payment_id is not null then 'matched' else 'timed_out' end as outcome
            from enriched e left join labels l on e.payment_id = l.payment_id
             and l.label_ts >= e.timestamp and l.label_ts <= e.timestamp + interval 60 day)
"""


def _stored_stream(v, df, name):
    folder = fresh_folder(v.spark, name)
    df.write.parquet(folder)
    return open_stream(v.spark, "parquet", {"path": folder}, df.schema), folder


@query("stream_enrich", _ENRICHED, _ENRICHED_VIEWS)
def stream_enrich(v):
    payments, _ = _stored_stream(v, _payments(v), "payments")
    path, checkpoint = fresh_folder(v.spark, "enriched"), fresh_folder(v.spark, "checkpoint")
    query_ = (
        L.enrich(payments, _profiles(v))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return _plain(v.spark.read.parquet(path))


@query("refresh_reference", _ENRICHED, _ENRICHED_VIEWS)
def refresh_reference(v):
    payments, _ = _stored_stream(v, _payments(v), "payments")
    path, checkpoint = fresh_folder(v.spark, "enriched"), fresh_folder(v.spark, "checkpoint")
    L.start_enrichment(payments, lambda: _profiles(v), path, checkpoint, interval=None).awaitTermination()
    return _plain(v.spark.read.parquet(path).drop("run_id", "epoch_id"))


_SENTINEL = "closing event"


def _matched_stream(v):
    """Result of the label stream over all payments and labels.

    All data first; then a closing event on both sides moves the watermark past
    everything that waits.
    """
    payments, payment_folder = _stored_stream(v, L.enrich(_payments(v), _profiles(v)), "payments")
    labels, label_folder = _stored_stream(v, _labels(v), "labels")
    path, checkpoint = fresh_folder(v.spark, "final"), fresh_folder(v.spark, "checkpoint")
    L.start_label_matching(payments, labels, TIMEOUT, path, checkpoint, interval=None).awaitTermination()
    _close(v, payment_folder, payments.schema, "timestamp")
    _close(v, label_folder, labels.schema, "label_ts")
    L.start_label_matching(payments, labels, TIMEOUT, path, checkpoint, interval=None).awaitTermination()
    found = v.spark.read.parquet(path).drop("run_id", "epoch_id").filter(F.col("payment_id") != _SENTINEL)
    return _plain(found.withColumn("outcome", F.col("outcome").cast("string")))


def _close(v, folder, schema, moment):
    row = [None] * len(schema)
    row[schema.names.index("payment_id")] = _SENTINEL
    far = v.spark.createDataFrame([tuple(row)], schema).withColumn(moment, F.lit("2200-01-01").cast("timestamp"))
    far.coalesce(1).write.mode("append").parquet(folder)


@query(
    "stream_quarantine",
    """select case when merchant_id <> 'merchant_4' then transaction_id end as transaction_id,
              case when merchant_id = 'merchant_4' then 'parsed' when coalesce(amount < 100, false) then '' else 'amount' end as failed,
              case when merchant_id = 'merchant_4' then 25 end as broken_chars from payment_events""",
    "payment_events",
)
def stream_quarantine(v):
    """Messages of one merchant arrive cut off; large amounts break a rule."""
    messages = to_messages(v.payment_events)
    cut = F.col("value").contains('"merchant_4"')
    folder, good, bad, checkpoint = (fresh_folder(v.spark, n) for n in ("messages", "good", "bad", "checkpoint"))
    messages.select(F.when(cut, F.substring("value", 1, 25)).otherwise(F.col("value")).alias("value")).write.parquet(folder)
    stream = open_stream(v.spark, "parquet", {"path": folder, "maxFilesPerTrigger": "4"}, MESSAGE)
    start_quarantine(stream, {"amount": F.col("amount") < 100}, good, bad, checkpoint, interval=None).awaitTermination()
    passed = v.spark.read.parquet(good).select("transaction_id", F.lit("").alias("failed"), F.lit(None).cast("int").alias("broken_chars"))
    chars = F.when(F.array_contains("failed_rules", "parsed"), F.length("raw")).alias("broken_chars")
    letters = v.spark.read.parquet(bad).select("transaction_id", F.array_join("failed_rules", ",").alias("failed"), chars)
    return passed.unionByName(letters)


@query(
    "stream_payment_features_1h",
    """with s as (select user_id, cast(floor(epoch(event_timestamp)) as bigint) as second, count(*) as n, sum(cast(round(amount * 100) as bigint)) as cents
                from payment_events where user_id is not null and event_timestamp is not null group by all)
       select user_id, second, n::bigint as n_rows, cast(sum(n) over w as bigint) as n_recent, cast(sum(cents) over w as bigint) as cents_recent
       from s window w as (partition by user_id order by second range between 3600 preceding and current row)""",
    "payment_events",
)
def stream_payment_features_1h(v):
    """The events as a file stream, oldest first; a closing event moves the watermark past the last one."""
    cents = F.round(F.col("amount") * 100).cast("long").alias("cents")
    events = v.payment_events.select("user_id", F.col("event_timestamp").cast("timestamp").alias("moment"), cents)
    feed = fresh_folder(v.spark, "activity-events")
    events.repartitionByRange(8, "moment").write.parquet(feed)
    stream = open_stream(v.spark, "parquet", {"path": feed}, events.schema)
    path, checkpoint = fresh_folder(v.spark, "activity"), fresh_folder(v.spark, "checkpoint")
    with stateful_stream(v.spark, 8):
        activity = recent_activity_stream(stream, "user_id", "moment", "cents")
        start_recent_activity(activity, path, checkpoint, interval=None).awaitTermination()
        closing = v.spark.range(1).select(F.lit(_SENTINEL), F.lit("2200-01-01").cast("timestamp"), F.lit(None).cast("long"))
        closing.toDF(*events.columns).write.mode("append").parquet(feed)
        start_recent_activity(activity, path, checkpoint, interval=None).awaitTermination()
    found = v.spark.read.schema(activity.schema).parquet(path).withColumnsRenamed({"key": "user_id", "at": "second"})
    return found.filter(F.col("user_id") != _SENTINEL)


_FINAL_VIEWS = _ENRICHED_VIEWS + " fraud_cases"


@query("stream_label_match", _FINAL + "select * from final where fraud_flag", _FINAL_VIEWS)
def stream_label_match(v):
    return _matched_stream(v).filter(F.col("outcome") == L.MATCHED)


@query("stream_label_timeout", _FINAL + "select * from final where not fraud_flag", _FINAL_VIEWS)
def stream_label_timeout(v):
    return _matched_stream(v).filter(F.col("outcome") == L.TIMED_OUT)


@query(
    "stream_late_label",
    _FINAL
    + """select l.payment_id, l.fraud_type, l.fraud_reported_date from labels l left join enriched e on e.payment_id = l.payment_id
             and l.label_ts >= e.timestamp and l.label_ts <= e.timestamp + interval 60 day where e.payment_id is null""",
    _FINAL_VIEWS,
)
def stream_late_label(v):
    late = _matched_stream(v).filter(F.col("outcome") == L.LATE)
    return late.select("payment_id", "fraud_type", "fraud_reported_date")


@query("stream_reconcile_batch", _FINAL + "select * from final", _FINAL_VIEWS)
def stream_reconcile_batch(v):
    # Enriched last, so the accounts are joined once.
    return _plain(L.enrich(L.reconcile_batch(_payments(v), _labels(v), TIMEOUT), _profiles(v)))


@query("stream_volume_check", VOLUME_BY_MONTH, "payments")
def stream_volume_check(v):
    """The payments as a file stream; the check reads the metrics of its micro-batches."""
    feed, path, checkpoint = (fresh_folder(v.spark, n) for n in ("payments", "volume", "checkpoint"))
    payments = _payments(v)
    payments.write.parquet(feed)
    stream = open_stream(v.spark, "parquet", {"path": feed, "maxFilesPerTrigger": "4"}, payments.schema)
    start_volume(stream, "timestamp", "month", path, checkpoint, interval=None).awaitTermination()
    found = volume_so_far(v.spark.read.parquet(path), "month", 0.9)
    return found.withColumn("period", F.col("period").cast("timestamp_ntz"))
