"""Scalar expressions over the test tables."""

from pyspark.sql import functions as F

from catalogue.registry import query
from tidemark.functions import dates as D
from tidemark.functions import scalars as S
from tidemark.functions import texts as X
from tidemark.functions.sql_functions import create_sql_function


@query(
    "surrogate_key",
    """select o_orderkey, md5(cast(o_orderkey as varchar) || '-' || coalesce(p, '_dbt_utils_surrogate_key_null_')
                              || '-' || coalesce(cast(cast(o_orderdate as date) as varchar), '_dbt_utils_surrogate_key_null_')) as order_sk,
              md5(coalesce(p, '') || '-' || coalesce(cast(o_custkey as varchar), '')) as legacy_sk, md5(o_orderpriority) as text_md5
       from (select *, nullif(o_orderstatus, 'P') as p from orders) t""",
)
def surrogate_key(v):
    orders = v.orders.withColumn("p", F.nullif("o_orderstatus", F.lit("P")))
    return orders.select(
        "o_orderkey",
        S.surrogate_key(["o_orderkey", "p", F.col("o_orderdate").cast("date")]).alias("order_sk"),
        S.surrogate_key(["p", "o_custkey"], null_as="").alias("legacy_sk"),
        S.text_hash("o_orderpriority").alias("text_md5"),
    )


_NULLABLE = "nullif(c_nationkey, 3) as a, nullif(c_custkey % 7, 2) as b, c_custkey % 5 as c"


def _nullable(v):
    key = F.col("c_custkey")
    return v.customer.select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("a"),
        F.nullif(key % 7, F.lit(2)).alias("b"),
        (key % 5).alias("c"),
    )


@query(
    "safe_add",
    f"select c_custkey, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) as total from (select c_custkey, {_NULLABLE} from customer) t",
)
def safe_add(v):
    return _nullable(v).select("c_custkey", S.safe_add(["a", "b", "c"]).alias("total"))


@query(
    "safe_subtract",
    f"select c_custkey, coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) as rest from (select c_custkey, {_NULLABLE} from customer) t",
)
def safe_subtract(v):
    return _nullable(v).select("c_custkey", S.safe_subtract(["a", "b", "c"]).alias("rest"))


@query(
    "safe_divide",
    f"""select c_custkey, cast(a as double) / nullif(cast(c as double), 0) as share
        from (select c_custkey, {_NULLABLE} from customer) t""",
)
def safe_divide(v):
    return _nullable(v).select("c_custkey", S.safe_divide(F.col("a").cast("double"), F.col("c").cast("double")).alias("share"))


@query(
    "width_bucket",
    """select c_custkey, cast(
         (case when cast(amount as decimal(28,6)) % cast(750.0 as decimal(28,6)) = 0 then 1 else 0 end)
         + least(ceil((amount - 500.0) / 750.0), 13) as bigint) as bucket
       from (select c_custkey, cast(round(c_acctbal / 250) * 250 as double) as amount from customer) t""",
)
def width_bucket(v):
    amount = (F.round(F.col("c_acctbal") / 250) * 250).cast("double")
    bucket = S.width_bucket(amount, F.lit(500.0), F.lit(9500.0), F.lit(12))
    return v.customer.select("c_custkey", bucket.alias("bucket"))


_PLACES = "(c_custkey * 7 % 170) - 85.0 as lat1, (c_custkey * 13 % 350) - 175.0 as lon1, (c_custkey * 11 % 160) - 80.0 as lat2, (c_custkey * 17 % 340) - 170.0 as lon2"
_HALF = """2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2)
           + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2)))"""


@query(
    "haversine_distance",
    f"""select c_custkey, round({_HALF}, 3) as miles, round({_HALF} * 1.60934, 3) as km
        from (select c_custkey, cast(lat1 as double) as lat1, cast(lon1 as double) as lon1, cast(lat2 as double) as lat2,
                     cast(lon2 as double) as lon2 from (select c_custkey, {_PLACES} from customer) t) p""",
)
def haversine_distance(v):
    key = F.col("c_custkey")
    places = v.customer.select(
        "c_custkey",
        (key * 7 % 170).cast("double") - 85,
        (key * 13 % 350).cast("double") - 175,
        (key * 11 % 160).cast("double") - 80,
        (key * 17 % 340).cast("double") - 170,
    ).toDF("c_custkey", "lat1", "lon1", "lat2", "lon2")
    points = ("lat1", "lon1", "lat2", "lon2")
    return places.select(
        "c_custkey",
        F.round(S.haversine_distance(*points), 3).alias("miles"),
        F.round(S.haversine_distance(*points, unit="km"), 3).alias("km"),
    )


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"
_START = f"coalesce(nullif(strpos({_BARE}, '/'), 0), strpos({_BARE}, '?') - 1)"


@query(
    "url_host",
    """select page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''),
              '/', 1), '?', 1) as host from pages""",
)
def url_host(v):
    return v.pages.select("page_id", X.url_host("url").alias("host"))


@query(
    "url_path",
    f"""select page_id, split_part(right({_BARE}, cast(length({_BARE}) - {_START} as integer)), '?', 1) as path,
               split_part(split_part(url, '?', 1), '/', 3) as bare
        from pages""",
)
def url_path(v):
    return v.pages.select(
        "page_id",
        X.url_path("url").alias("path"),
        X.split_part(X.split_part("url", "?", 1), "/", 3).alias("bare"),
    )


@query(
    "url_parameter",
    """select page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page_no,
              nullif(split_part(split_part(url, 'source=', 2), '&', 1), '') as source from pages""",
)
def url_parameter(v):
    return v.pages.select(
        "page_id", X.url_parameter("url", "page").alias("page_no"), X.url_parameter("url", "source").alias("source")
    )


@query(
    "split_part",
    """select c_custkey, split_part(c_name, '#', 1) as first_part, split_part(c_name, '#', -1) as last_part,
              split_part(c_name, '#', 3) as third_part from customer""",
)
def split_part(v):
    return v.customer.select(
        "c_custkey",
        X.split_part("c_name", "#", 1).alias("first_part"),
        X.split_part("c_name", "#", -1).alias("last_part"),
        X.split_part("c_name", "#", 3).alias("third_part"),
    )


@query(
    "string_basics",
    """select p_partkey, length(p_name) as n, right(p_name, 4) as tail, right(p_name, -2) as rest, replace(p_name, 'r', 'RR') as swapped,
              strpos(p_name, 'g') as g_at, p_name || '/' || p_brand as joined,
              case when nullif(p_size, 5) is null then null else p_name || cast(p_size as varchar) end as joined_null,
              'it''s' as quoted, cast(p_size > 10 as varchar) as large from part""",
)
def string_basics(v):
    return v.part.select(
        "p_partkey",
        X.length("p_name").cast("long").alias("n"),
        X.right("p_name", 4).alias("tail"),
        X.right("p_name", -2).alias("rest"),
        X.replace("p_name", "r", "RR").alias("swapped"),
        X.position("g", "p_name").cast("long").alias("g_at"),
        X.concat(["p_name", F.lit("/"), "p_brand"]).alias("joined"),
        X.concat(["p_name", F.nullif("p_size", F.lit(5))]).alias("joined_null"),
        X.string_literal("it's").alias("quoted"),
        X.bool_to_text(F.col("p_size") > 10).alias("large"),
    )


@query(
    "array_basics",
    """select n_nationkey, array_to_string(list_append([n_nationkey, n_regionkey], 7), ',') as appended,
              array_to_string(list_concat([n_nationkey, n_regionkey], [1, 2]), ',') as joined,
              cast(len(cast([] as integer[])) as integer) as empty_size from nation""",
)
def array_basics(v):
    pair = X.array_construct(["n_nationkey", "n_regionkey"])

    def text(array):
        return F.array_join(array.cast("array<string>"), ",")

    return v.nation.select(
        "n_nationkey",
        text(X.array_append(pair, 7)).alias("appended"),
        text(X.array_concat(pair, X.array_construct([1, 2]))).alias("joined"),
        F.size(X.array_construct((), "int")).alias("empty_size"),
    )


@query(
    "date_trunc",
    "select event_id, "
    + ", ".join(f"date_trunc('{p}', ts) as {p}_start" for p in ("year", "quarter", "month", "day", "hour", "minute"))
    + " from events",
)
def date_trunc(v):
    parts = ("year", "quarter", "month", "day", "hour", "minute")
    return v.events.select(
        "event_id", *[D.date_trunc(p, "ts").cast("timestamp_ntz").alias(f"{p}_start") for p in parts]
    )


@query(
    "dateadd",
    """select o_orderkey, o_orderdate + interval 1 month as next_month, o_orderdate + interval '-1' year as last_year,
              o_orderdate + interval '1 day' * cast(o_orderkey % 10 as integer) as some_days,
              o_orderdate + interval '90 minute' as later, o_orderdate + interval 2 week as two_weeks from orders""",
)
def dateadd(v):
    return v.orders.select(
        "o_orderkey",
        D.dateadd("month", F.lit(1), "o_orderdate").alias("next_month"),
        D.dateadd("year", F.lit(-1), "o_orderdate").alias("last_year"),
        D.dateadd("day", F.col("o_orderkey") % 10, "o_orderdate").alias("some_days"),
        D.dateadd("minute", F.lit(90), "o_orderdate").alias("later"),
        D.dateadd("week", F.lit(2), "o_orderdate").alias("two_weeks"),
    )


_DIFF = {
    "year": "(year(b) - year(a))",
    "quarter": "((year(b) - year(a)) * 4 + quarter(b) - quarter(a))",
    "month": "((year(b) - year(a)) * 12 + month(b) - month(a))",
    "day": "(cast(b as date) - cast(a as date))",
    "week": """(trunc((cast(b as date) - cast(a as date)) / 7.0) + case when dayofweek(a) <= dayofweek(b)
               then case when a <= b then 0 else -1 end else case when a <= b then 1 else 0 end end)""",
}
_DIFF["hour"] = f"({_DIFF['day']} * 24 + hour(b) - hour(a))"
_DIFF["minute"] = f"({_DIFF['hour']} * 60 + minute(b) - minute(a))"
_DIFF["second"] = f"({_DIFF['minute']} * 60 + second(b) - second(a))"
_DIFF["millisecond"] = f"({_DIFF['minute']} * 60000 + millisecond(b) - millisecond(a))"
_DIFF["microsecond"] = f"({_DIFF['minute']} * 60000000 + microsecond(b) - microsecond(a))"


@query(
    "datediff",
    "select event_id, "
    + ", ".join(f"cast({e} as bigint) as {p}s" for p, e in _DIFF.items())
    + """ from (select event_id, ts as a, case when event_id % 2 = 0 then timestamp '2024-01-17 11:58:59.5' else ts + interval 400 day end as b
               from events) t""",
)
def datediff(v):
    moved = F.when(F.col("event_id") % 2 == 0, F.lit("2024-01-17 11:58:59.5").cast("timestamp_ntz")).otherwise(
        D.dateadd("day", F.lit(400), "ts")
    )
    pairs = v.events.select("event_id", F.col("ts").alias("a"), moved.alias("b"))
    return pairs.select("event_id", *[D.datediff("a", "b", p).alias(f"{p}s") for p in _DIFF])


@query(
    "last_day",
    """select o_orderkey, last_day(o_orderdate) as month_end,
              cast(date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day as date) as quarter_end,
              cast(date_trunc('year', o_orderdate) + interval 1 year - interval 1 day as date) as year_end from orders""",
)
def last_day(v):
    return v.orders.select(
        "o_orderkey",
        D.last_day("o_orderdate").alias("month_end"),
        D.last_day("o_orderdate", "quarter").alias("quarter_end"),
        D.last_day("o_orderdate", "year").alias("year_end"),
    )


@query(
    "make_date_literal",
    """select o_orderkey, make_date(1998, 2, 28) as cut, cast(o_orderdate as date) > make_date(1998, 2, 28) as after_cut from orders""",
)
def make_date_literal(v):
    cut = D.make_date(1998, 2, 28)
    return v.orders.select("o_orderkey", cut.alias("cut"), (F.col("o_orderdate").cast("date") > cut).alias("after_cut"))


@query(
    "sql_scalar_function",
    "select o_orderkey, o_totalprice * (1 + 0.5e0) + 1 as gross from orders",
)
def sql_scalar_function(v):
    create_sql_function(v.spark, "tm_gross", {"net": "double", "rate": "double"}, "double", "net * (1 + rate) + 1")
    return v.orders.select("o_orderkey", F.expr("tm_gross(o_totalprice, 0.5)").alias("gross"))
