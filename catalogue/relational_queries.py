"""Projections, pivots, unions, deduplication and series over the test tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.registry import query
from tidemark.functions import scalars as S
from tidemark.operators import relational as R
from tidemark.operators import reporting, series

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("star_except", "select o_orderkey as src_o_orderkey_id, o_custkey as src_o_custkey_id, o_orderdate as src_o_orderdate_id from orders")
def star_except(v):
    orders = v.orders
    return orders.select(*R.star_except(orders, ["O_TOTALPRICE", "o_orderstatus", "o_orderpriority"], "src_", "_id"))


@query(
    "nullcheck_table",
    """select doc_id, nullif(lang, '') as lang, nullif(source, '') as source, n_chars, nullif(tail, '') as tail
       from (select doc_id, case when lang = 'en' then '' else lang end as lang, source, n_chars,
                    case when n_chars > 2000 then '' else source end as tail from documents) d""",
)
def nullcheck_table(v):
    blanked = v.documents.select(
        "doc_id",
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"),
        "source",
        "n_chars",
        F.when(F.col("n_chars") > 2000, "").otherwise(F.col("source")).alias("tail"),
    )
    return R.nullcheck_table(blanked)


@query(
    "cast_columns",
    """select o_orderkey, cast(o_orderkey as varchar) as key_text, cast(o_totalprice as decimal(28,6)) as price,
              cast(o_orderdate as date) as day, try_cast(o_orderpriority as integer) as bad_number,
              try_cast(substring(o_orderpriority, 1, 1) as integer) as level from orders""",
)
def cast_columns(v):
    return v.orders.select(
        "o_orderkey",
        S.cast_to("o_orderkey", "string").alias("key_text"),
        S.cast_to("o_totalprice", S.NUMERIC).alias("price"),
        S.cast_to("o_orderdate", "date").alias("day"),
        S.try_cast_to("o_orderpriority", "int").alias("bad_number"),
        S.try_cast_to(F.substring("o_orderpriority", 1, 1), "int").alias("level"),
    )


@query(
    "null_safe_equals",
    """select vec_id, a = b as plain, a is not distinct from b as nulls_match
       from (select e.vec_id, nullif(e.label, 0) as a, nullif(l.quality, 0) as b
             from embeddings e left join labels l on e.vec_id = l.doc_id) t""",
)
def null_safe_equals(v):
    joined = v.embeddings.join(v.labels, F.col("vec_id") == F.col("doc_id"), "left").select(
        "vec_id", F.nullif("label", F.lit(0)).alias("a"), F.nullif("quality", F.lit(0)).alias("b")
    )
    return joined.select("vec_id", S.equals("a", "b").alias("plain"), S.equals("a", "b", True).alias("nulls_match"))


@query(
    "group_by_n",
    """select l_returnflag, l_linestatus, count(*) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as sum_qty
       from lineitem group by 1, 2""",
)
def group_by_n(v):
    lines = v.lineitem.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("long").alias("qty"))
    return R.group_by_n(lines, 2).agg(F.count("*").alias("n_lines"), F.sum("qty").alias("sum_qty"))


@query(
    "pivot",
    "select o_orderstatus, "
    + ", ".join(
        f"cast(sum(case when o_orderpriority = '{p}' then 1 else 0 end) as bigint) as \"n_{p}\"" for p in PRIORITIES
    )
    + ", count(distinct case when o_orderpriority = '1-URGENT' then o_custkey end) as \"who_1-URGENT\""
    + " from orders group by o_orderstatus",
)
def pivot(v):
    urgent = R.pivot_columns(
        "o_orderpriority", ["1-URGENT"], agg="count", prefix="who_", then_value=F.col("o_custkey"), else_value=None, distinct=True
    )
    return v.orders.groupBy("o_orderstatus").agg(*R.pivot_columns("o_orderpriority", PRIORITIES, prefix="n_"), *urgent)


@query(
    "unpivot",
    " union all ".join(
        f"select l_orderkey, l_linenumber, '{c}' as field_name, cast({e} as varchar) as value from lineitem"
        for c, e in (("l_partkey", "l_partkey"), ("l_returnflag", "l_returnflag"), ("returned", "l_returnflag = 'R'"))
    ),
)
def unpivot(v):
    lines = v.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", (F.col("l_returnflag") == "R").alias("returned")
    )
    return R.unpivot(lines, exclude=["l_orderkey", "l_linenumber"], remove=["l_suppkey"])


@query(
    "union_relations",
    """select 'customer' as _dbt_source_relation, c_custkey as party_key, c_name as party_name, c_nationkey as nation_key,
              c_mktsegment as segment, cast(null as double) as balance from customer where c_nationkey < 20
       union all
       select 'supplier', s_suppkey, s_name, s_nationkey, null, s_acctbal from supplier where s_nationkey < 20""",
)
def union_relations(v):
    customers = v.customer.select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = v.supplier.select(
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("balance"),
        F.lit("x").alias("note"),
    )
    return R.union_relations({"customer": customers, "supplier": suppliers}, exclude=["NOTE"], where="nation_key < 20")


@query(
    "union_by_pattern",
    """select concat('tm_events_', event_type) as _dbt_source_relation, event_id, user_id, value
       from events where event_type <> 'error'""",
)
def union_by_pattern(v):
    events, kinds = v.events, ("view", "signup", "click", "error", "purchase")
    for kind in kinds:
        part = events.filter(F.col("event_type") == kind).select("event_id", "user_id", "value")
        part.createOrReplaceTempView(f"tm_events_{kind}")
    union = R.union_by_pattern(v.spark, "", "TM_EVENTS_%", exclude="%error")
    for kind in kinds:
        v.spark.catalog.dropTempView(f"tm_events_{kind}")
    return union


@query(
    "intersect_distinct",
    "select l_partkey as part_key from lineitem where l_returnflag = 'R' intersect select p_partkey from part where p_size > 25",
)
def intersect_distinct(v):
    returned = v.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("part_key"))
    return R.intersect_distinct(returned, v.part.filter("p_size > 25").select("p_partkey"))


@query(
    "deduplicate",
    """select o_orderkey, o_custkey, o_orderdate, o_totalprice from (
         select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls first, o_orderkey) as rn
         from orders) t where rn = 1""",
)
def deduplicate(v):
    orders = v.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return R.deduplicate(orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(), "o_orderkey"])


@query(
    "listagg",
    """select o_custkey, string_agg(o_orderpriority, ' | ' order by o_orderdate nulls last, o_orderkey) as priorities,
              (select coalesce(string_agg(p, ', ' order by rn), '') from (
                 select case when o_orderstatus = 'P' then null else o_orderstatus end as p,
                        row_number() over (order by o_orderdate desc nulls first, o_orderkey) as rn
                 from orders i where i.o_custkey is not distinct from o.o_custkey) f where rn <= 3) as last_states
       from orders o group by o_custkey""",
)
def listagg(v):
    orders = v.orders.select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("state"),
    )
    full = orders.groupBy("o_custkey").agg(
        R.listagg("o_orderpriority", " | ", "o_orderdate asc nulls last, o_orderkey").alias("priorities")
    )
    newest = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey")]
    last = R.listagg_first(orders, ["o_custkey"], "state", ", ", newest, 3, "last_states")
    last = last.withColumnRenamed("o_custkey", "_custkey")
    return full.join(last, F.col("o_custkey").eqNullSafe(F.col("_custkey"))).drop("_custkey")


@query(
    "any_value",
    "select o_custkey, min(o_orderpriority) as some_priority, min(o_orderdate) as some_date from orders group by o_custkey",
)
def any_value(v):
    return v.orders.groupBy("o_custkey").agg(
        S.any_value("o_orderpriority").alias("some_priority"), S.any_value("o_orderdate").alias("some_date")
    )


@query(
    "bool_or",
    """select l_orderkey, bool_or(case when l_linestatus = 'O' then l_returnflag = 'R' end) as any_returned
       from lineitem group by l_orderkey""",
)
def bool_or(v):
    returned = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag") == "R")
    return v.lineitem.groupBy("l_orderkey").agg(S.bool_or(returned).alias("any_returned"))


@query(
    "column_values",
    """select lang as value, 'all' as list from (select lang, count(*) from documents group by lang) t
       union all
       select source, 'top5' from (select source, count(*) as n from documents where n_chars > 500 group by source
                                   order by n desc, source limit 5) t""",
)
def column_values(v):
    every = R.column_values(v.documents, "lang").withColumn("list", F.lit("all"))
    top = R.column_values(v.documents, "source", max_records=5, where="n_chars > 500").withColumn("list", F.lit("top5"))
    return every.unionByName(top)


@query(
    "single_value",
    """select (select max(o_orderdate) from orders) as newest,
              coalesce((select o_orderkey from orders where o_totalprice < 0 limit 1), -1) as missing""",
)
def single_value(v):
    newest = R.single_value(v.orders.agg(F.max("o_orderdate"))).withColumnRenamed("value", "newest")
    missing = R.single_value(v.orders.filter("o_totalprice < 0").select("o_orderkey"), default=-1)
    return newest.select("newest", missing.scalar().cast("long").alias("missing"))


@query(
    "generate_series",
    """select g.generated_number, count(o_orderkey) as n_orders
       from (select unnest(generate_series(1, (select max(c_custkey) from customer))) as generated_number) g
       left join orders o on g.generated_number = o.o_custkey group by 1""",
)
def generate_series(v):
    upper = v.customer.agg(F.max("c_custkey").alias("n")).first().n
    counts = v.orders.groupBy(F.col("o_custkey").alias("generated_number")).agg(F.count("*").alias("n_orders"))
    joined = series.generate_series(v.spark, upper).join(counts, "generated_number", "left")
    return joined.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "date_spine",
    """with span as (select min(o_orderdate) as a, max(o_orderdate) as b from orders),
            days as (select unnest(generate_series(a, b - interval 1 day, interval 1 day)) as date_day from span)
       select date_day, count(o_orderkey) as n_orders from days left join orders on o_orderdate = date_day group by 1""",
)
def date_spine(v):
    counts = v.orders.groupBy(F.col("o_orderdate").alias("date_day")).agg(F.count("*").alias("n_orders"))
    joined = series.date_spine_over(v.orders, "o_orderdate", "day").join(counts, "date_day", "left")
    return joined.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "dates_in_range",
    """select strftime(l_shipdate, '%Y%m%d') as day_label, count(*) as n_lines from lineitem
       where l_shipdate >= timestamp '1998-02-20' and l_shipdate < timestamp '1998-03-11' group by 1""",
)
def dates_in_range(v):
    days = series.read_days(v.lineitem, "l_shipdate", "19980220,19980310")
    return days.groupBy(F.date_format("l_shipdate", "yyyyMMdd").alias("day_label")).agg(F.count("*").alias("n_lines"))


@query("schema_contract", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def schema_contract(v):
    declared = T.StructType(
        [
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_mktsegment", T.StringType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
        ]
    )
    return reporting.enforce_contract(v.customer, declared)
