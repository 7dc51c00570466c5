"""Staging, risk history and the payment mart."""

import uuid

from pyspark.sql import functions as F

from catalogue.quality_queries import suite_sql
from catalogue.registry import query
from catalogue.views import LOADS
from tidemark.operators import history as H
from tidemark.operators.relational import deduplicate
from tidemark.plans import batch, mart, risk, staging
from tidemark.plans.risk import RISK_RULES
from tidemark.schemas import LANDED_FILES
from tidemark.session import fresh_folder, shared_folder, staged


@query("stg_payments", "select payment_id, source_account_id, destination_account_id, payment_reference, amount, payment_timestamp from payments", "payments")
def stg_payments(v):
    return staging.stg_payments(v.payments)


@query("stg_accounts", "select account_id, opening_date from accounts", "accounts")
def stg_accounts(v):
    return staging.stg_accounts(v.accounts)


@query("stg_risk_feed", "select account_id, risk_score from risk_feed_v1", "risk_feed_v1")
def stg_risk_feed(v):
    return staging.stg_risk_feed(v.risk_feed_v1)


@query("stg_fraud_cases", "select payment_id, is_fraud as is_fraud_flag, fraud_type, fraud_reported_date from fraud_cases", "fraud_cases")
def stg_fraud_cases(v):
    return staging.stg_fraud_cases(v.fraud_cases)


_FLAG = "risk_score > 70 as risk_flag, case when risk_score > 70 then 'High Risk' else 'Low Risk' end as risk_flag_text"


@query("risk_flagging", f"select account_id, risk_score, {_FLAG} from (select account_id, nullif(risk_score, 60) as risk_score from risk_feed_v1) t", "risk_feed_v1")
def risk_flagging(v):
    feed = v.risk_feed_v1.withColumn("risk_score", F.nullif("risk_score", F.lit(60.0)))
    return risk.risk_flagging(feed)


@query("amount_risk_score", "select *, amount * 0.01e0 as risk_score from payment_events", "payment_events")
def amount_risk_score(v):
    return risk.amount_risk_score(v.payment_events)


@query(
    "date_window_filter",
    """select payment_id, amount, payment_timestamp from payments
       where payment_timestamp >= timestamp '1996-03-01' and payment_timestamp < timestamp '1998-09-01'""",
    "payments",
)
def date_window_filter(v):
    window = mart.date_window_filter(staging.stg_payments(v.payments), "1996-03-01", "1998-09-01")
    return window.select("payment_id", "amount", "payment_timestamp")


@query(
    "join_accounts_twice",
    """select p.*, s.opening_date as source_opening_date, d.opening_date as destination_opening_date from payments p
       left join accounts s on p.source_account_id = s.account_id
       left join accounts d on p.destination_account_id = d.account_id""",
    "payments accounts",
)
def join_accounts_twice(v):
    return mart.join_accounts_twice(v.payments, v.accounts)


_ASOF = """left join account_risk_snapshot {r} on p.{role}_account_id = {r}.account_id
  and p.payment_timestamp >= {r}.dbt_valid_from
  and p.payment_timestamp < coalesce({r}.dbt_valid_to, timestamp '9999-12-31 00:00:00')"""


@query(
    "asof_risk_join",
    "select p.*, s.risk_flag as source_risk_flag, d.risk_flag as destination_risk_flag from payments p "
    + _ASOF.format(r="s", role="source")
    + " "
    + _ASOF.format(r="d", role="destination"),
    "payments account_risk_snapshot",
)
def asof_risk_join(v):
    return mart.asof_risk_join(v.payments, v.account_risk_snapshot)


@query(
    "join_fraud_cases",
    """select p.*, f.fraud_type is not null as is_fraud_flag, f.fraud_type, f.fraud_reported_date
       from payments p left join fraud_cases f on p.payment_id = f.payment_id""",
    "payments fraud_cases",
)
def join_fraud_cases(v):
    return mart.join_fraud_cases(v.payments, v.stg_fraud_cases)


@query("unified_payment_intelligence", "select * from mart", "mart")
def unified_payment_intelligence(v):
    return v.mart()


@query(
    "date_range_rebuild",
    """select payment_id, source_account_id, destination_account_id, case when inside then amount else amount + 1 end as amount,
              timestamp, source_opening_date, destination_opening_date, source_risk_flag, destination_risk_flag,
              is_fraud_flag, fraud_type, fraud_reported_date
       from (select *, timestamp >= timestamp '1997-01-01' and timestamp < timestamp '1998-01-01' as inside from mart) m""",
    "mart",
)
def date_range_rebuild(v):
    """A stored mart with stale amounts; the months of 1997 are rebuilt in place."""
    table = f"tm_{uuid.uuid4().hex}"
    stale = v.mart().withColumn("amount", F.col("amount") + 1)
    batch.store_mart(stale, table, "month", shared_folder(v.spark))
    return batch.date_range_rebuild(v.spark, table, v.mart, "1997-01-01", "1998-01-01", "month").drop(batch.PERIOD)


_BATCH_MART = """select p.payment_id, p.source_account_id, p.destination_account_id, p.amount, p.payment_timestamp as timestamp,
         sa.opening_date as source_opening_date, da.opening_date as destination_opening_date,
         coalesce(sr.risk_score > 70, false) as source_risk_flag, coalesce(dr.risk_score > 70, false) as destination_risk_flag,
         f.fraud_type is not null as is_fraud_flag, f.fraud_type, f.fraud_reported_date
       from payments p
       left join accounts sa on p.source_account_id = sa.account_id
       left join accounts da on p.destination_account_id = da.account_id
       left join risk_feed_v1 sr on p.source_account_id = sr.account_id and p.payment_timestamp >= timestamp '1990-01-01'
       left join risk_feed_v1 dr on p.destination_account_id = dr.account_id and p.payment_timestamp >= timestamp '1990-01-01'
       left join fraud_cases f on p.payment_id = f.payment_id"""
_BATCH_VIEWS = "payments accounts risk_feed_v1 fraud_cases"


def _whole_batch(v):
    """The raw tables land as CSV files and go through the whole run; the prefix of its tables."""
    folder = fresh_folder(v.spark, "landed")
    sources = {"raw_payments": v.payments, "raw_accounts": v.accounts, "raw_risk_feed": v.risk_feed_v1, "raw_fraud_cases": v.fraud_cases}
    for file_name, (table, schema) in LANDED_FILES.items():
        sources[table].select(*schema.names).write.option("header", "true").csv(f"{folder}/{file_name}")
    prefix = f"tm_{uuid.uuid4().hex}_"
    raw = batch.load_raw(v.spark, folder, prefix, shared_folder(v.spark))
    batch.run_batch(v.spark, raw, "1990-01-01 00:00:00", prefix, folder=shared_folder(v.spark))
    return prefix


@query("batch_run", _BATCH_MART, _BATCH_VIEWS)
def batch_run(v):
    mart_ = v.spark.table(_whole_batch(v) + batch.MART)
    return mart_.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("batch_report", f"with mart as ({_BATCH_MART}) {suite_sql('risk_feed_v1')}", _BATCH_VIEWS)
def batch_report(v):
    """The report that the whole run stores."""
    return v.spark.table(_whole_batch(v) + batch.REPORT)


# --- history ------------------------------------------------------------------------


@query(
    "scd_id",
    "select account_id, md5(account_id || '|' || cast(as_of as varchar)) as dbt_scd_id, md5(account_id || '|' || '') as no_time from feed",
    "feed",
)
def scd_id(v):
    union = None
    for as_of, feed in v.loads:
        part = feed.select("account_id", F.lit(as_of).cast("timestamp_ntz").alias("as_of"))
        union = part if union is None else union.unionByName(part)
    nothing = F.lit(None).cast("timestamp_ntz")
    return union.select(
        "account_id", H.scd_id(["account_id", "as_of"]).alias("dbt_scd_id"), H.scd_id(["account_id", nothing]).alias("no_time")
    )


_META = """md5(account_id || '|1995-01-01 00:00:00') as dbt_scd_id, timestamp '1995-01-01' as dbt_updated_at,
           timestamp '1995-01-01' as dbt_valid_from"""


@query("scd2_initial", f"select account_id, risk_score, {_FLAG}, {_META}, cast(null as timestamp) as dbt_valid_to from risk_feed_v0", "risk_feed_v0")
def scd2_initial(v):
    return H.initial_history(risk.risk_flagging(v.risk_feed_v0), RISK_RULES, LOADS[0])


def _first(v, rules=RISK_RULES):
    return H.initial_history(risk.risk_flagging(v.risk_feed_v0), rules, LOADS[0])


@query(
    "scd2_check",
    """select n.account_id, n.risk_score, o.risk_score as old_score from risk_feed_v1 n join risk_feed_v0 o using (account_id)
       where n.risk_score is distinct from o.risk_score""",
    "risk_feed_v0 risk_feed_v1",
)
def scd2_check(v):
    old = v.risk_feed_v0.select("account_id", F.col("risk_score").alias("old_score"))
    changed = H.check_changed(
        ["account_id", "risk_score"],
        ["account_id", "risk_score"],
        H.HistoryRules(keys=("account_id",), check="all"),
        lambda c: F.col("old_score") if c == "risk_score" else F.col(c),
        F.col,
    )
    return v.risk_feed_v1.join(old, "account_id").filter(changed)


_STAMPED = H.HistoryRules(keys=("o_custkey",), updated_at="last_order")
_RUN1, _RUN2, _RUN3 = "1997-07-01", "1999-07-01", "2100-01-01"


def _accounts_at(v, since, until):
    """Latest order of each customer with an order of ``[since, until)``, its time as the update time."""
    low, high = (F.lit(moment).cast("timestamp_ntz") for moment in (since, until))
    known = v.orders.filter((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high))
    newest = deduplicate(known, ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("last_order"))


@query(
    "scd2_timestamp",
    f"""with runs(run) as (values (timestamp '{_RUN1}'), (timestamp '{_RUN2}'), (timestamp '{_RUN3}')),
            seen as (select run, o_custkey, o_orderkey, o_orderdate as last_order,
                 row_number() over (partition by run, o_custkey order by o_orderdate desc, o_orderkey) as rn
                 from orders join runs on o_orderdate < run),
            versions as (select distinct o_custkey, o_orderkey, last_order from seen where rn = 1)
       select o_custkey, o_orderkey, last_order, md5(coalesce(cast(o_custkey as varchar), '') || '|' || coalesce(cast(last_order as varchar), '')) as dbt_scd_id,
              last_order as dbt_updated_at, last_order as dbt_valid_from,
              lead(last_order) over (partition by o_custkey order by last_order) as dbt_valid_to from versions""",
)
def scd2_timestamp(v):
    """Every run gets the orders since the one before; the last comes after the newest order."""
    kept, since = None, "0001-01-01"
    for run in (_RUN1, _RUN2, _RUN3):
        kept, since = staged(v.spark, "history")(H.snapshot(kept, _accounts_at(v, since, run), _STAMPED, run)), run
    return kept


_DROPPING = H.HistoryRules(keys=("account_id",), check=("risk_score",), hard_deletes="invalidate")
_OLD_ID = "md5(o.account_id || '|1995-01-01 00:00:00')"


@query(
    "scd2_stage_changes",
    f"""select 'insert' as dbt_change_type, n.account_id, n.risk_score, md5(n.account_id || '|1999-01-01 00:00:00') as dbt_scd_id,
               timestamp '1999-01-01' as dbt_updated_at, timestamp '1999-01-01' as dbt_valid_from, cast(null as timestamp) as dbt_valid_to
        from risk_feed_v2 n left join risk_feed_v0 o using (account_id)
        where o.account_id is null or n.risk_score is distinct from o.risk_score
        union all
        select 'update', n.account_id, n.risk_score, {_OLD_ID}, timestamp '1999-01-01', timestamp '1999-01-01', timestamp '1999-01-01'
        from risk_feed_v2 n join risk_feed_v0 o using (account_id) where n.risk_score is distinct from o.risk_score
        union all
        select 'delete', null, null, {_OLD_ID}, timestamp '1999-01-01', timestamp '1999-01-01', timestamp '1999-01-01'
        from risk_feed_v0 o anti join risk_feed_v2 n using (account_id)""",
    "risk_feed_v0 risk_feed_v2",
)
def scd2_stage_changes(v):
    target = H.initial_history(v.risk_feed_v0, _DROPPING, LOADS[0])
    return H.stage_changes(target, v.risk_feed_v2, _DROPPING, LOADS[2])


_CLOSED = """select o.account_id, o.risk_score, md5(o.account_id || '|1995-01-01 00:00:00') as dbt_scd_id,
               timestamp '1995-01-01' as dbt_updated_at, timestamp '1995-01-01' as dbt_valid_from,
               case when n.account_id is null or n.risk_score is distinct from o.risk_score then timestamp '1999-01-01' end as dbt_valid_to
        from risk_feed_v0 o left join risk_feed_v2 n using (account_id)"""
_FRESH = """select n.account_id, n.risk_score, md5(n.account_id || '|1999-01-01 00:00:00'), timestamp '1999-01-01',
               timestamp '1999-01-01', cast(null as timestamp)
        from risk_feed_v2 n left join risk_feed_v0 o using (account_id)
        where o.account_id is null or n.risk_score is distinct from o.risk_score"""


@query("scd2_merge", f"{_CLOSED} union all {_FRESH}", "risk_feed_v0 risk_feed_v2")
def scd2_merge(v):
    target = H.initial_history(v.risk_feed_v0, _DROPPING, LOADS[0])
    changes = H.stage_changes(target, v.risk_feed_v2, _DROPPING, LOADS[2])
    return H.merge_changes(target, staged(v.spark, "changes")(changes), _DROPPING)


_MARKING = H.HistoryRules(keys=("account_id",), check=("risk_score",), hard_deletes="new_record")


@query(
    "scd2_hard_deletes",
    f"""select *, 'False' as dbt_is_deleted from ({_CLOSED} union all {_FRESH}) t
        union all
        select o.account_id, o.risk_score, md5({_OLD_ID} || '|1999-01-01 00:00:00'), timestamp '1999-01-01',
               timestamp '1999-01-01', cast(null as timestamp), 'True'
        from risk_feed_v0 o anti join risk_feed_v2 n using (account_id)""",
    "risk_feed_v0 risk_feed_v2",
)
def scd2_hard_deletes(v):
    target = H.initial_history(v.risk_feed_v0, _MARKING, LOADS[0])
    return H.snapshot(target, v.risk_feed_v2, _MARKING, LOADS[2], staged(v.spark, "changes"))


_OPTIONS = H.HistoryRules(
    keys=("l_orderkey", "l_partkey"),
    check=("n_lines",),
    open_until="9999-12-31 00:00:00",
    renamed={"dbt_valid_from": "valid_from", "dbt_valid_to": "valid_to"},
)


@query(
    "scd2_options",
    """with a as (select l_orderkey, l_partkey, count(*) as n_lines from lineitem where l_returnflag <> 'R' group by 1, 2),
            b as (select l_orderkey, l_partkey, count(*) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as qty
                  from lineitem group by 1, 2)
       select l_orderkey, l_partkey, a.n_lines, md5(coalesce(cast(l_orderkey as varchar), '') || '|' || coalesce(cast(l_partkey as varchar), '') || '|1995-01-01 00:00:00') as dbt_scd_id,
              timestamp '1995-01-01' as dbt_updated_at, timestamp '1995-01-01' as valid_from,
              case when a.n_lines <> b.n_lines then timestamp '1997-01-01' else timestamp '9999-12-31' end as valid_to,
              cast(null as bigint) as qty
       from a left join b using (l_orderkey, l_partkey)
       union all
       select l_orderkey, l_partkey, b.n_lines, md5(coalesce(cast(l_orderkey as varchar), '') || '|' || coalesce(cast(l_partkey as varchar), '') || '|1997-01-01 00:00:00'),
              timestamp '1997-01-01', timestamp '1997-01-01', timestamp '9999-12-31', b.qty
       from b left join a using (l_orderkey, l_partkey) where a.n_lines is null or a.n_lines <> b.n_lines""",
)
def scd2_options(v):
    """Composite key, fixed end of open rows, renamed columns, and a column new in the second run."""
    keys = ("l_orderkey", "l_partkey")
    before = v.lineitem.filter("l_returnflag <> 'R'").groupBy(*keys).agg(F.count("*").alias("n_lines"))
    after = v.lineitem.groupBy(*keys).agg(F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    return H.snapshot(H.snapshot(None, before, _OPTIONS, LOADS[0]), after, _OPTIONS, LOADS[1], staged(v.spark, "changes"))


@query(
    "account_risk_snapshot",
    """select account_id, risk_score, risk_flag, risk_flag_text,
              md5(account_id || '|' || cast(dbt_valid_from as varchar)) as dbt_scd_id, dbt_valid_from as dbt_updated_at,
              dbt_valid_from, dbt_valid_to from account_risk_snapshot""",
    "account_risk_snapshot",
)
def account_risk_snapshot(v):
    return v.account_risk_snapshot
