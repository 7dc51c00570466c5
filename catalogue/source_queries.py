"""Sources and sinks as round trips through the shared folder."""

import os
import uuid

from pyspark.sql import functions as F

from catalogue.registry import query
from tidemark import schemas
from tidemark.operators import quality as Q
from tidemark.operators.reporting import store_failures
from tidemark.session import fresh_folder, shared_folder
from tidemark.sources import events as E
from tidemark.sources.files import consolidate_batch, load_csv_typed, load_seed
from tidemark.sources.tables import materialize_table
from tidemark.streaming.layers import append_micro_batch, write_layers


def _land(v, folder):
    """The four raw tables as CSV files (folders) under their landing names."""
    raw = {
        "raw_payments": v.payments,
        "raw_accounts": v.accounts,
        "raw_risk_feed": v.risk_feed_v1,
        "raw_fraud_cases": v.fraud_cases,
    }
    for file_name, (table, _) in schemas.LANDED_FILES.items():
        raw[table].write.option("header", "true").csv(os.path.join(folder, file_name))


@query("load_csv_typed", "select * from payments", "payments")
def csv_round_trip(v):
    folder = fresh_folder(v.spark, "landed")
    v.payments.write.option("header", "true").csv(folder)
    loaded = load_csv_typed(v.spark, folder, schemas.RAW_PAYMENTS)
    return loaded.withColumn("payment_timestamp", F.col("payment_timestamp").cast("timestamp_ntz"))


@query(
    "consolidate_batch",
    """select 'raw_payments' as table_name, count(*) as n_rows from payments union all
       select 'raw_accounts', count(*) from accounts union all select 'raw_risk_feed', count(*) from risk_feed_v1 union all
       select 'raw_fraud_cases', count(*) from fraud_cases""",
    "payments accounts risk_feed_v1 fraud_cases",
)
def landed_tables(v):
    folder, stored = fresh_folder(v.spark, "landed"), fresh_folder(v.spark, "raw")
    _land(v, folder)

    def store(df, table):
        df.write.parquet(f"{stored}/{table}")
        return v.spark.read.parquet(f"{stored}/{table}")

    counts = consolidate_batch(v.spark, folder, store)
    return v.spark.createDataFrame(list(counts.items()), "table_name string, n_rows long")


@query("parse_payment_events", "select * from payment_events", "payment_events")
def parsed_events(v):
    parsed = E.parse_payment_events(E.to_messages(v.payment_events))
    return parsed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


BOTH_LAYERS = """select *, amount * 0.01e0 as risk_score, 'silver' as layer from payment_events
  union all select *, null, 'bronze' from payment_events"""


def both_layers(spark, bronze, silver):
    """Rows of both layers, with the bronze stamp checked and left out."""
    stamped = spark.read.parquet(bronze).filter("processing_ts is not null").drop("processing_ts", "run_id", "epoch_id")
    scored = spark.read.parquet(silver).drop("run_id", "epoch_id").withColumn("layer", F.lit("silver"))
    return scored.unionByName(stamped.withColumn("layer", F.lit("bronze")), allowMissingColumns=True)


@query("bronze_silver_fanout", BOTH_LAYERS, "payment_events")
def fanned_out(v):
    bronze, silver = fresh_folder(v.spark, "bronze"), fresh_folder(v.spark, "silver")
    for _ in range(2):  # the second write stands for a retry and adds nothing
        write_layers(v.payment_events, 0, bronze, silver, "run")
    return both_layers(v.spark, bronze, silver)


@query("sink_parquet_append", "select currency, count(*) as n_events, cast(sum(cast(amount * 100 as bigint)) as bigint) as cents from payment_events group by 1", "payment_events")
def appended(v):
    path = fresh_folder(v.spark, "landing")
    for epoch, currency in enumerate(("USD", "EUR", "GBP")):
        append_micro_batch(v.payment_events.filter(F.col("currency") == currency), epoch, path, "run")
    cents = F.sum(F.round(F.col("amount") * 100).cast("long")).alias("cents")
    return v.spark.read.parquet(path).groupBy("currency").agg(F.count("*").alias("n_events"), cents)


@query("load_seed", "select n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation union all select p_partkey, p_name, cast(p_size as varchar) from part")
def seeded(v):
    path = fresh_folder(v.spark, "seed")
    names = ["n_nationkey", "n_name", "n_regionkey"]
    both = v.nation.select(*names).union(v.part.select("p_partkey", "p_name", "p_size"))
    both.write.option("header", "true").csv(path)
    seed = load_seed(v.spark, path, {"N_REGIONKEY": "string"})
    return seed.withColumn("n_nationkey", F.col("n_nationkey").cast("long"))


@query("materialize_table", "select o_custkey, count(*) as n_orders, max(o_orderdate) as newest from orders group by 1")
def materialized(v):
    """Built twice, the second time from the table it replaces."""
    table = f"tm_{uuid.uuid4().hex}"
    first = v.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("newest"))
    return materialize_table(materialize_table(first, table, folder=shared_folder(v.spark)).select("*"), table, folder=shared_folder(v.spark))


@query(
    "store_failures",
    """select o_orderkey, o_totalprice, kept from orders cross join (values ('view'), ('table')) k(kept)
       where not (o_totalprice > 100000)""",
)
def kept_failures(v):
    """Both forms: a view that is computed on use, and a stored table."""
    found = None
    for kept in ("view", "table"):
        name = f"tm_{uuid.uuid4().hex}"
        failing = Q.expression_is_true(v.orders.select("o_orderkey", "o_totalprice"), "> 100000", "o_totalprice")
        store_failures(failing, name, as_view=kept == "view")
        rows = v.spark.table(name).withColumn("kept", F.lit(kept))
        found = rows if found is None else found.unionByName(rows)
    return found
