"""Incremental write strategies: orders before a cut as target, repriced later orders as batch."""

import uuid

from pyspark.sql import functions as F

from catalogue.registry import query
from tidemark.operators import incremental as I
from tidemark.session import shared_folder
from tidemark.sources.tables import run_incremental

_COLS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
_CTES = """with target as (select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders where o_orderdate < timestamp '2000-01-01'),
 batch as (select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice, o_orderdate + interval 1 hour as o_orderdate
           from orders where o_orderdate >= timestamp '1999-07-01')
"""


def _target(v):
    return v.orders.select(*_COLS).filter("o_orderdate < timestamp_ntz'2000-01-01'")


def _batch(v):
    late = v.orders.select(*_COLS).filter("o_orderdate >= timestamp_ntz'1999-07-01'")
    return late.withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn(
        "o_orderdate", F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate"))
    )


@query("incr_append", _CTES + "select * from target union all select * from batch")
def incr_append(v):
    return I.append(_target(v), _batch(v))


@query(
    "incr_delete_insert",
    _CTES
    + """select * from target where (o_custkey in (select o_custkey from batch) and o_orderdate >= timestamp '1998-01-01') is not true
         union all select * from batch""",
)
def incr_delete_insert(v):
    return I.delete_insert(_target(v), _batch(v), "o_custkey", ["o_orderdate >= timestamp_ntz'1998-01-01'"])


@query("incr_merge", _CTES + "select * from target anti join batch using (o_orderkey) union all select * from batch")
def incr_merge(v):
    return I.merge(_target(v), _batch(v), "o_orderkey")


@query(
    "incr_merge_columns",
    _CTES
    + """select t.o_orderkey, t.o_custkey, coalesce(b.o_totalprice, t.o_totalprice) as o_totalprice, t.o_orderdate
         from target t left join batch b using (o_orderkey)
         union all select * from batch anti join target using (o_orderkey)""",
)
def incr_merge_columns(v):
    return I.merge(_target(v), _batch(v), ["o_orderkey"], merge_exclude_columns=["O_ORDERDATE", "o_custkey", "o_orderkey"])


@query(
    "incr_insert_overwrite",
    _CTES + "select * from target where (o_orderdate >= timestamp '1999-07-01') is not true union all select * from batch",
)
def incr_insert_overwrite(v):
    return I.insert_overwrite(_target(v), _batch(v), ["o_orderdate >= timestamp_ntz'1999-07-01'"])


@query("incr_microbatch", _CTES + "select * from target anti join batch using (o_orderkey) union all select * from batch")
def incr_microbatch(v):
    """The batch runs beyond the last edge; those rows arrive too."""
    edges = ["1999-07-01 00:00:00", "2000-01-01 00:00:00", "2000-07-01 00:00:00", "2001-01-01 00:00:00"]
    return I.microbatch(_target(v), _batch(v), "o_orderkey", "o_orderdate", edges)


@query(
    "incr_partition_rewrite",
    _CTES
    + """, u as (select * from target anti join batch using (o_orderkey) union all select * from batch)
         select o_orderkey, o_totalprice, o_custkey % 7 as part from u""",
)
def incr_partition_rewrite(v):
    """A stored table partitioned by customer group: the upsert rewrites the groups it touches."""
    table = f"tm_{uuid.uuid4().hex}"

    def laid_out(df):
        return df.select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 7).alias("part"))

    for rows in (_target(v), _batch(v)):
        stored = run_incremental(
            v.spark, table, lambda current, rows=rows: laid_out(rows), "merge", "o_orderkey",
            partition_by=["part"], folder=shared_folder(v.spark),
        )
    return stored


@query(
    "schema_change",
    _CTES
    + """select o_orderkey, cast(o_totalprice as decimal(28,6)) as o_totalprice, o_orderdate, cast(null as varchar) as tier from target
         union all
         select o_orderkey, cast(o_totalprice as decimal(28,6)), o_orderdate, case when o_totalprice > 250000 then 'large' else 'small' end
         from batch""",
)
def schema_change(v):
    """A column added, one removed and one retyped, all synchronized."""
    tier = F.when(F.col("o_totalprice") > 250000, "large").otherwise("small")
    batch = _batch(v).withColumn("tier", tier).drop("o_custkey")
    batch = batch.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(28,6)"))
    target, columns = I.reconcile_schema(_target(v), batch, "sync_all_columns")
    return I.append(target, batch, columns)


@query("incr_driver", _CTES + "select * from target anti join batch using (o_orderkey) union all select * from batch")
def incr_driver(v):
    """First run creates the table, second run applies delete+insert (the default with a key)."""
    table = f"tm_{uuid.uuid4().hex}"

    def build(current):
        return _target(v) if current is None else _batch(v)

    for _ in range(2):
        stored = run_incremental(v.spark, table, build, unique_key="o_orderkey", folder=shared_folder(v.spark))
    return stored
