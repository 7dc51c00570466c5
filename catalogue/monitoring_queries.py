"""Monitoring over the payments and the mart."""

from pyspark.sql import functions as F

from catalogue.registry import query
from tidemark.operators import monitoring as M

_CENTS = "cast(round(amount * 100) as bigint)"

VOLUME_BY_MONTH = """with c as (select date_trunc('month', payment_timestamp)::timestamp as period, count(*) as n from payments where payment_timestamp is not null group by 1),
            s as (select unnest(generate_series(min(period), max(period), interval 1 month))::timestamp as period from c),
            f as (select period, coalesce(n, 0) as n_rows from s left join c using (period))
       select *, lag(n_rows) over (order by period) as n_before, coalesce(n_rows < 0.9 * lag(n_rows) over (order by period), false) as dropped from f"""


def _cents(df):
    return df.withColumn("cents", F.round(F.col("amount") * 100).cast("long"))


@query(
    "quarantine_split",
    """select payment_id, amount, concat_ws(',', case when not coalesce(amount < 300000, false) then 'amount' end,
         case when source_account_id = destination_account_id or destination_account_id like '%7' then 'accounts' end) as failed
       from payments""",
    "payments",
)
def quarantine_split(v):
    rules = {
        "amount": F.col("amount") < 300000,
        "accounts": (F.col("source_account_id") != F.col("destination_account_id")) & ~F.col("destination_account_id").like("%7"),
    }
    good, bad = M.quarantine_split(v.payments.select("payment_id", "amount", "source_account_id", "destination_account_id"), rules)
    failed = bad.select("payment_id", "amount", F.array_join("failed_rules", ",").alias("failed"))
    return failed.unionByName(good.select("payment_id", "amount", F.lit("").alias("failed")))


@query(
    "payment_features_1h",
    f"""select transaction_id, user_id, cast(count(*) over w as bigint) as n_recent, cast(sum({_CENTS}) over w as bigint) as cents_recent from payment_events
        window w as (partition by user_id order by epoch(event_timestamp)::bigint range between 3600 preceding and current row)""",
    "payment_events",
)
def payment_features_1h(v):
    events = _cents(v.payment_events).select("transaction_id", "user_id", "event_timestamp", "cents")
    found = M.recent_activity(events, "user_id", "event_timestamp", "cents")
    return found.select("transaction_id", "user_id", "n_recent", "cents_recent")


@query("volume_check", VOLUME_BY_MONTH, "payments")
def volume_check(v):
    found = M.volume_check(v.payments, "payment_timestamp", "month", 0.9)
    return found.withColumn("period", F.col("period").cast("timestamp_ntz"))


@query(
    "drift_profile",
    f"""with v as (select date_trunc('month', timestamp)::timestamp as period, {_CENTS} as cents, source_risk_flag as flag from mart where timestamp is not null),
       b as (select *, greatest(length(bin(abs(cents))) - 6, 0) as shift from v),
       h as (select period, case when cents < 0 then -1 else 1 end * (shift * 32 + (abs(cents) >> shift)) as bucket, count(*) as n from b where cents is not null group by all),
       t as (select period, count(*) as n_rows, count(cents) as n_values, sum(cents)::double / nullif(count(cents), 0) as mean_cents,
               count(*) filter (flag)::double / count(*) as flag_share from v group by 1),
       s as (select unnest(generate_series(min(period), max(period), interval 1 month))::timestamp as period from t),
       d as (select bucket, coalesce(sum(n) filter (period = (select min(period) from h)), 0)::bigint as base from h group by 1),
       e as (select *, (sum(base) over (order by bucket))::bigint as upto, (sum(base) over ())::bigint as total from d),
       f as (select *, coalesce(max(case when base > 0 then 10 * (upto - base) // total end) over (order by bucket), 0) as bin from e),
       g as (select t.period, t.n_values, f.*, coalesce(h.n, 0) as n, sum(coalesce(h.n, 0)) over (partition by t.period order by f.bucket) as below
             from t cross join f left join h on h.period = t.period and h.bucket = f.bucket where t.n_values > 0),
       k as (select period, bin, sum(n) as n, sum(base) as base, max(abs(below::double / n_values - upto::double / total)) as gap,
               any_value(n_values) as n_values, any_value(total) as total, count(*) over (partition by period) as used from g group by period, bin),
       p as (select *, (n + 0.5::double) / (n_values + 0.5::double * used) as p, (base + 0.5::double) / (total + 0.5::double * used) as q from k),
       x as (select period, sum((p - q) * ln(p / q)) as psi, max(gap) as largest_gap from p group by 1)
       select period, coalesce(n_rows, 0) as n_rows, mean_cents, flag_share, round(psi, 9) as psi, round(largest_gap, 9) as largest_gap,
         mean_cents - lag(mean_cents) over (order by period) as mean_cents_change,
         flag_share - lag(flag_share) over (order by period) as flag_share_change
       from s left join t using (period) left join x using (period)""",
    "mart",
)
def drift_profile(v):
    found = M.drift_profile(_cents(v.mart()), "timestamp", "cents", "source_risk_flag")
    rounded = {c: F.round(c, 9) for c in ("psi", "largest_gap")}
    return found.withColumns({"period": F.col("period").cast("timestamp_ntz"), **rounded})
