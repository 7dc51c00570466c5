"""Domain tables over the test tables: payments, accounts, risk feeds, fraud cases, events.

Each exists twice: as DataFrame here and as SQL for the checks.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import risk, staging
from tidemark.plans.mart import unified_payment_intelligence
from tidemark.session import staged

# Times of the three loads of the risk feed.
LOADS = ("1995-01-01 00:00:00", "1997-01-01 00:00:00", "1999-01-01 00:00:00")


def _id(prefix: str, number) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


class Views:
    """The tables of one folder; a table is opened when it is first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        opened = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = opened
        return opened

    @cached_property
    def accounts(self):
        key = F.col("c_custkey")
        opened = F.date_add(F.lit("1990-01-01").cast("date"), (key % 1500).cast("int"))
        return self.customer.select(_id("acc_", key).alias("account_id"), opened.alias("opening_date"))

    @cached_property
    def payments(self):
        order, account = F.col("o_orderkey"), F.col("o_custkey")
        n = self.customer.agg(F.count("*").alias("n")).scalar()
        return self.orders.select(
            _id("pay_", order).alias("payment_id"),
            _id("acc_", account).alias("source_account_id"),
            _id("acc_", (account + 1 + order % (n - 1)) % n).alias("destination_account_id"),
            _id("ref_", order % 90000 + 10000).alias("payment_reference"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("payment_timestamp"),
        )

    def _risk(self, bump, keep):
        key = F.col("c_custkey")
        score = ((key * 7 + bump) % 51 + 50).cast("double")
        return self.customer.filter(keep).select(_id("acc_", key).alias("account_id"), score.alias("risk_score"))

    @cached_property
    def risk_feed_v0(self):
        return self._risk(F.lit(0), F.col("c_custkey") % 5 == 0)

    @cached_property
    def risk_feed_v1(self):
        key = F.col("c_custkey")
        return self._risk(F.when(key % 2 == 0, 13).otherwise(0), (key % 5 == 0) | (key % 10 == 1))

    @cached_property
    def risk_feed_v2(self):
        return self.risk_feed_v1.filter(F.substring("account_id", 5, 20).cast("int") % 25 != 0)

    @cached_property
    def fraud_cases(self):
        order = F.col("o_orderkey")
        kind = F.when(order % 3 == 0, "Money Mule").when(order % 3 == 1, "APP Fraud").otherwise("Identity Theft")
        reported = F.date_add(F.col("o_orderdate").cast("date"), (order % 61 + 30).cast("int"))
        return self.orders.filter(order % 20 == 0).select(
            _id("pay_", order).alias("payment_id"),
            F.lit(True).alias("is_fraud"),
            kind.alias("fraud_type"),
            reported.alias("fraud_reported_date"),
        )

    @cached_property
    def payment_events(self):
        event, user = F.col("event_id"), F.col("user_id")
        return self.events.select(
            _id("txn_", event).alias("transaction_id"),
            _id("user_", user).alias("user_id"),
            _id("User ", user).alias("user_name"),
            F.col("value").alias("amount"),
            F.when(event % 3 == 0, "USD").when(event % 3 == 1, "EUR").otherwise("GBP").alias("currency"),
            _id("merchant_", event % 100 + 1).alias("merchant_id"),
            F.col("ts").alias("event_timestamp"),
        )

    @cached_property
    def loads(self):
        return list(zip(LOADS, (self.risk_feed_v0, self.risk_feed_v1, self.risk_feed_v2)))

    @cached_property
    def account_risk_snapshot(self):
        """Kept as a written table, as the snapshot job leaves it."""
        store = staged(self.spark, "history")
        return store(risk.fold_snapshots(self.loads, store))

    @cached_property
    def stg_fraud_cases(self):
        return staging.stg_fraud_cases(self.fraud_cases)

    def mart(self, start_date=None, end_date=None) -> DataFrame:
        return unified_payment_intelligence(
            staging.stg_payments(self.payments),
            staging.stg_accounts(self.accounts),
            self.account_risk_snapshot,
            self.stg_fraud_cases,
            start_date,
            end_date,
            versions_bound=len(LOADS),
        )


# --- the same as SQL ----------------------------------------------------------------

VIEW_SQL = {
    "accounts": """
select 'acc_' || cast(c_custkey as string) as account_id,
       date '1990-01-01' + cast(c_custkey % 1500 as int) as opening_date
from customer""",
    "payments": """
select 'pay_' || cast(o_orderkey as string) as payment_id,
       'acc_' || cast(o_custkey as string) as source_account_id,
       'acc_' || cast((o_custkey + 1 + o_orderkey % (n - 1)) % n as string) as destination_account_id,
       'ref_' || cast(10000 + o_orderkey % 90000 as string) as payment_reference,
       o_totalprice as amount, o_orderdate as payment_timestamp
from orders cross join (select count(*) as n from customer) c""",
    "risk_feed_v0": """
select 'acc_' || cast(c_custkey as string) as account_id,
       cast(50 + (c_custkey * 7) % 51 as double) as risk_score
from customer where c_custkey % 5 = 0""",
    "risk_feed_v1": """
select 'acc_' || cast(c_custkey as string) as account_id,
       cast(50 + (c_custkey * 7 + case when c_custkey % 2 = 0 then 13 else 0 end) % 51 as double) as risk_score
from customer where c_custkey % 5 = 0 or c_custkey % 10 = 1""",
    "risk_feed_v2": """
select * from risk_feed_v1 where cast(substring(account_id, 5) as int) % 25 <> 0""",
    "fraud_cases": """
select 'pay_' || cast(o_orderkey as string) as payment_id, true as is_fraud,
       case o_orderkey % 3 when 0 then 'Money Mule' when 1 then 'APP Fraud' else 'Identity Theft' end as fraud_type,
       cast(o_orderdate as date) + cast(30 + o_orderkey % 61 as int) as fraud_reported_date
from orders where o_orderkey % 20 = 0""",
    "payment_events": """
select 'txn_' || cast(event_id as string) as transaction_id, 'user_' || cast(user_id as string) as user_id,
       'User ' || cast(user_id as string) as user_name, value as amount,
       case event_id % 3 when 0 then 'USD' when 1 then 'EUR' else 'GBP' end as currency,
       'merchant_' || cast(1 + event_id % 100 as string) as merchant_id, ts as event_timestamp
from events""",
    "feed": """
select account_id, risk_score, timestamp '1995-01-01 00:00:00' as as_of from risk_feed_v0
union all select account_id, risk_score, timestamp '1997-01-01 00:00:00' as as_of from risk_feed_v1
union all select account_id, risk_score, timestamp '1999-01-01 00:00:00' as as_of from risk_feed_v2""",
    "flagged": """
select account_id, risk_score, risk_score > 70 as risk_flag,
       case when risk_score > 70 then 'High Risk' else 'Low Risk' end as risk_flag_text, as_of,
       lag(risk_score) over (partition by account_id order by as_of) as prev_score,
       row_number() over (partition by account_id order by as_of) as rn
from feed""",
    "account_risk_snapshot": """
select account_id, risk_score, risk_flag, risk_flag_text, as_of as dbt_valid_from,
       lead(as_of) over (partition by account_id order by as_of) as dbt_valid_to
from flagged where rn = 1 or risk_score is distinct from prev_score""",
    "mart": """
select p.payment_id, p.source_account_id, p.destination_account_id, p.amount, p.payment_timestamp as timestamp,
       sa.opening_date as source_opening_date, da.opening_date as destination_opening_date,
       coalesce(sr.risk_flag, false) as source_risk_flag, coalesce(dr.risk_flag, false) as destination_risk_flag,
       f.fraud_type is not null as is_fraud_flag, f.fraud_type, f.fraud_reported_date
from payments p
left join accounts sa on p.source_account_id = sa.account_id
left join accounts da on p.destination_account_id = da.account_id
left join account_risk_snapshot sr on p.source_account_id = sr.account_id
  and p.payment_timestamp >= sr.dbt_valid_from
  and p.payment_timestamp < coalesce(sr.dbt_valid_to, timestamp '9999-12-31 00:00:00')
left join account_risk_snapshot dr on p.destination_account_id = dr.account_id
  and p.payment_timestamp >= dr.dbt_valid_from
  and p.payment_timestamp < coalesce(dr.dbt_valid_to, timestamp '9999-12-31 00:00:00')
left join fraud_cases f on p.payment_id = f.payment_id""",
}

_NEEDS = {
    "risk_feed_v2": ["risk_feed_v1"],
    "feed": ["risk_feed_v0", "risk_feed_v1", "risk_feed_v2"],
    "flagged": ["feed"],
    "account_risk_snapshot": ["flagged"],
    "mart": ["payments", "accounts", "account_risk_snapshot", "fraud_cases"],
}


def with_views(names: str, body: str) -> str:
    """``body`` after the CTEs of the named views and of all they need."""
    ordered: list[str] = []

    def add(name):
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({VIEW_SQL[name].strip()})" for name in ordered)
    text = body.strip()
    joiner = ",\n" + text[5:] if text[:5].lower() == "with " else "\n" + text
    return f"with {ctes}{joiner}"
