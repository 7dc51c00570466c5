"""Data tests over the test tables, most of them on input that fails."""

from pyspark.sql import functions as F

from catalogue.registry import query
from tidemark.operators import quality as Q
from tidemark.operators import reporting as P
from tidemark.plans import checks, staging
from tidemark.session import staged


@query("test_unique", "select source_account_id as unique_field, count(*) as n_records from payments where source_account_id is not null group by 1 having count(*) > 1", "payments")
def test_unique(v):
    return Q.unique(v.payments, "source_account_id")


@query("test_not_null", "select account_id, risk_score, dbt_valid_from, dbt_valid_to from account_risk_snapshot where dbt_valid_to is null", "account_risk_snapshot")
def test_not_null(v):
    return Q.not_null(v.account_risk_snapshot, "dbt_valid_to").select("account_id", "risk_score", "dbt_valid_from", "dbt_valid_to")


@query(
    "test_accepted_values",
    "select o_orderpriority as value_field, count(*) as n_records from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '5-LOW') group by 1",
)
def test_accepted_values(v):
    return Q.accepted_values(v.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("test_not_accepted_values", "select distinct lang as value_field from documents where lang in ('en', 'xx', 'fr')")
def test_not_accepted_values(v):
    return Q.not_accepted_values(v.documents, "lang", ["en", "xx", "fr"])


@query(
    "test_relationships",
    """select source_account_id as from_field from payments p left join risk_feed_v1 r on p.source_account_id = r.account_id
       where r.account_id is null and source_account_id is not null""",
    "payments risk_feed_v1",
)
def test_relationships(v):
    return Q.relationships(v.payments, "source_account_id", v.risk_feed_v1, "account_id")


@query(
    "test_relationships_where",
    """select source_account_id as id, cast(null as varchar) as right_id from payments p
       left join (select account_id from risk_feed_v1 where risk_score > 60) r on p.source_account_id = r.account_id
       where r.account_id is null and p.source_account_id is not null and amount > 100000""",
    "payments risk_feed_v1",
)
def test_relationships_where(v):
    return Q.relationships_where(v.payments, "source_account_id", v.risk_feed_v1, "account_id", "amount > 100000", "risk_score > 60")


@query(
    "test_is_after",
    """select o_orderkey, o_orderdate, l_shipdate from orders join lineitem on o_orderkey = l_orderkey where l_shipdate < o_orderdate""",
)
def test_is_after(v):
    joined = v.orders.join(v.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return Q.is_after(joined.select("o_orderkey", "o_orderdate", "l_shipdate"), "l_shipdate", "o_orderdate")


@query("test_row_count", "select count(*) as total_rows from payments having count(*) < 1000000000", "payments")
def test_row_count(v):
    return Q.row_count(v.payments, 1_000_000_000)


@query(
    "test_fraud_counts_match",
    """select f.n as final_model_count, s.n as staging_model_count
       from (select count(distinct payment_id) as n from mart where is_fraud_flag and amount > 100000) f,
            (select count(distinct payment_id) as n from fraud_cases) s where f.n <> s.n""",
    "mart",
)
def test_fraud_counts_match(v):
    return Q.fraud_counts_match(v.mart().filter("amount > 100000"), v.stg_fraud_cases)


@query("test_accepted_range", "select p_partkey, p_size from part where not p_size >= 5 or not p_size <= 45")
def test_accepted_range(v):
    return Q.accepted_range(v.part.select("p_partkey", "p_size"), "p_size", 5, 45)


@query(
    "test_at_least_one",
    """select c_nationkey, c_mktsegment, count(v) as filler_column
       from (select c_nationkey, c_mktsegment, case when c_acctbal > 9000 then c_acctbal end as v from customer) t
       group by 1, 2 having count(v) = 0""",
)
def test_at_least_one(v):
    rich = F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("v")
    return Q.at_least_one(v.customer.select("c_nationkey", "c_mktsegment", rich), "v", ["c_nationkey", "c_mktsegment"])


@query(
    "test_cardinality_equality",
    """with a as (select l_suppkey, count(*) as num_rows from lineitem where l_returnflag = 'R' group by 1),
            b as (select l_suppkey, count(*) as num_rows from lineitem where l_returnflag = 'A' group by 1)
       (select * from a except select * from b) union all (select * from b except select * from a)""",
)
def test_cardinality_equality(v):
    lines = v.lineitem
    return Q.cardinality_equality(
        lines.filter("l_returnflag = 'R'"), "l_suppkey", lines.filter("l_returnflag = 'A'"), "l_suppkey"
    )


_GROUPED = """with a as (select o_custkey, o_orderstatus, count(*) as n from orders where o_orderdate < timestamp '1999-01-01' group by 1, 2),
                   b as (select o_custkey, o_orderstatus, count(*) as n from orders where o_orderdate >= timestamp '1997-01-01' group by 1, 2)"""


def _halves(v):
    orders = v.orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    return orders.filter("o_orderdate < timestamp_ntz'1999-01-01'"), orders.filter("o_orderdate >= timestamp_ntz'1997-01-01'")


@query(
    "test_equal_rowcount",
    _GROUPED
    + """select case when a.n is not null then 1 end as id_dbtutils_test_equal_rowcount_a,
                case when b.n is not null then 1 end as id_dbtutils_test_equal_rowcount_b,
                a.o_custkey as o_custkey_a, b.o_custkey as o_custkey_b, a.o_orderstatus as o_orderstatus_a,
                b.o_orderstatus as o_orderstatus_b, a.n as count_a, b.n as count_b, abs(a.n - b.n) as diff_count
         from a full join b on a.o_custkey = b.o_custkey and a.o_orderstatus = b.o_orderstatus""",
)
def test_equal_rowcount(v):
    before, after = _halves(v)
    return Q.equal_rowcount(before, after, ["o_custkey", "o_orderstatus"])


@query(
    "test_fewer_rows_than",
    _GROUPED
    + """select case when a.n is not null then 1 end as id_dbtutils_test_fewer_rows_than_a,
                case when b.n is not null then 1 end as id_dbtutils_test_fewer_rows_than_b,
                a.o_custkey as o_custkey_a, b.o_custkey as o_custkey_b, a.o_orderstatus as o_orderstatus_a,
                b.o_orderstatus as o_orderstatus_b, a.n as count_our_model, b.n as count_comparison_model,
                cast(case when a.n > b.n then a.n - b.n when a.n = b.n then 1 else 0 end as bigint) as row_count_delta
         from a full join b on a.o_custkey = b.o_custkey and a.o_orderstatus = b.o_orderstatus""",
)
def test_fewer_rows_than(v):
    before, after = _halves(v)
    return Q.fewer_rows_than(before, after, ["o_custkey", "o_orderstatus"])


@query(
    "test_equality",
    """with a as (select account_id, round(cast(risk_score / 7 as decimal(28,6)), 2) as score from risk_feed_v0),
            b as (select account_id, round(cast(risk_score / 7 as decimal(28,6)), 2) as score from risk_feed_v1)
       select 'a_minus_b' as which_diff, * from (select * from a except select * from b) x
       union all select 'b_minus_a', * from (select * from b except select * from a) y""",
    "risk_feed_v0 risk_feed_v1",
)
def test_equality(v):
    def side(feed, note):
        return feed.select("account_id", (F.col("risk_score") / 7).alias("score"), F.lit(note).alias("note"))

    return Q.equality(side(v.risk_feed_v0, "x"), side(v.risk_feed_v1, "y"), exclude_columns=["NOTE"], precision=2)


@query("test_expression_is_true", "select p_partkey, p_size, p_retailprice from part where not (p_retailprice > p_size * 40)")
def test_expression_is_true(v):
    return Q.expression_is_true(v.part.select("p_partkey", "p_size", "p_retailprice"), "> p_size * 40", "p_retailprice")


_RANGES = """select {part} lower_bound, upper_bound, next_lower_bound, is_last_record,
         coalesce(lower_bound < upper_bound, false) as lower_bound_less_than_upper_bound,
         coalesce(upper_bound {op} next_lower_bound, is_last_record, false) as upper_bound_{words}_next_lower_bound
       from (select *, lead(lower_bound) over ({by} order by lower_bound nulls last, upper_bound nulls last) as next_lower_bound,
                    row_number() over ({by} order by lower_bound nulls last, upper_bound nulls last) = count(*) over ({by}) as is_last_record
             from ({source}) s) w"""


@query(
    "test_mutually_exclusive_ranges",
    "select * from ("
    + _RANGES.format(
        part="partition_by_col,",
        by="partition by partition_by_col",
        op="<=",
        words="less_than_or_equal_to",
        source="""select o_custkey as partition_by_col, o_orderdate as lower_bound,
                         o_orderdate + interval '1 day' * cast(o_orderkey % 60 as integer) as upper_bound from orders""",
    )
    + ") e where not (lower_bound_less_than_upper_bound and upper_bound_less_than_or_equal_to_next_lower_bound)",
)
def test_mutually_exclusive_ranges(v):
    until = F.timestamp_add("DAY", (F.col("o_orderkey") % 60).cast("int"), F.col("o_orderdate"))
    return Q.mutually_exclusive_ranges(v.orders.withColumn("until", until), "o_orderdate", "until", "o_custkey")


@query(
    "test_ranges_of_history",
    "select * from ("
    + _RANGES.format(
        part="partition_by_col,",
        by="partition by partition_by_col",
        op="=",
        words="equal_to",
        source="""select account_id as partition_by_col, dbt_valid_from as lower_bound,
                  coalesce(dbt_valid_to, timestamp '9999-12-31') as upper_bound from account_risk_snapshot""",
    )
    + ") e where not (lower_bound_less_than_upper_bound and upper_bound_equal_to_next_lower_bound)",
    "account_risk_snapshot",
)
def test_ranges_of_history(v):
    """The risk history has neither overlaps nor gaps: no rows."""
    end = F.coalesce("dbt_valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))
    history = v.account_risk_snapshot.withColumn("valid_to", end)
    return Q.mutually_exclusive_ranges(history, "dbt_valid_from", "valid_to", "account_id", gaps="not_allowed")


@query(
    "test_not_constant",
    "select l_orderkey, count(distinct l_returnflag) as filler_column from lineitem group by 1 having count(distinct l_returnflag) = 1",
)
def test_not_constant(v):
    return Q.not_constant(v.lineitem, "l_returnflag", ["l_orderkey"])


@query("test_not_empty_string", "select trim(tail) as tail from (select replace(p_name, 'small ring', '  ') as tail from part) t where trim(tail) = ''")
def test_not_empty_string(v):
    return Q.not_empty_string(v.part.select(F.replace("p_name", F.lit("small ring"), F.lit("  ")).alias("tail")), "tail")


@query(
    "test_not_null_proportion",
    """select c_nationkey, count(v) / cast(count(*) as double) as not_null_proportion
       from (select c_nationkey, case when c_acctbal > 5000 then 1 end as v from customer) t
       group by 1 having count(v) / cast(count(*) as double) < 0.5 or count(v) / cast(count(*) as double) > 0.55""",
)
def test_not_null_proportion(v):
    flagged = v.customer.select("c_nationkey", F.when(F.col("c_acctbal") > 5000, 1).alias("v"))
    found = Q.not_null_proportion(flagged, "v", 0.5, 0.55, ["c_nationkey"])
    return found


@query(
    "test_recency",
    """select o_custkey, max(o_orderdate) as most_recent, timestamp '2001-08-01' - interval 90 day as threshold from orders
       group by 1 having max(o_orderdate) < timestamp '2001-08-01' - interval 90 day""",
)
def test_recency(v):
    return Q.recency(v.orders, "o_orderdate", "day", 90, "2001-08-01 00:00:00", group_by=["o_custkey"])


@query(
    "test_sequential_values",
    """select * from (select o_custkey, o_orderkey, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) as previous_o_orderkey
                      from orders) t where not (o_orderkey = previous_o_orderkey + 7)""",
)
def test_sequential_values(v):
    return Q.sequential_values(v.orders, "o_orderkey", 7, group_by=["o_custkey"])


@query(
    "test_sequential_dates",
    """select * from (select o_orderdate, lag(o_orderdate) over (order by o_orderdate) as previous_o_orderdate from orders) t
       where not (o_orderdate = previous_o_orderdate + interval 1 day)""",
)
def test_sequential_dates(v):
    """Over the whole table, with many equal dates; cut into blocks, as on a large table."""
    return Q.sequential_values(v.orders, "o_orderdate", 1, part="day", hot_rows=max(1, v.orders.count() // 6))


@query("test_unique_combination", "select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1")
def test_unique_combination(v):
    return Q.unique_combination(v.lineitem, ["l_orderkey", "l_linenumber"])


@query("test_assert_equal", "select doc_id, n_chars, length(text) as measured from documents where n_chars <> length(text)")
def test_assert_equal(v):
    measured = v.documents.select("doc_id", "n_chars", F.char_length("text").cast("long").alias("measured"))
    return Q.assert_equal(measured, "n_chars", "measured")


@query(
    "test_runner",
    """select count(*) as failures, count(*) > 10 as should_warn, count(*) > 1000000000 as should_error
       from (select l_orderkey, l_linenumber from lineitem where l_returnflag <> 'N' group by 1, 2 having count(*) > 1) t""",
)
def test_runner(v):
    lines = v.lineitem.filter("l_returnflag <> 'N'")
    return P.run_test(Q.unique_combination(lines, ["l_orderkey", "l_linenumber"]), warn_if="> 10", error_if="> 1000000000")


_SUITE = [
    ("unified_payment_intelligence", "row_count", "error", "select count(*) from (select count(*) as n from mart) t where n < 100"),
    ("unified_payment_intelligence", "unique_payment_id", "error", "select count(*) from (select payment_id from mart group by 1 having count(*) > 1) t"),
    ("unified_payment_intelligence", "not_null_payment_id", "error", "select count(*) from mart where payment_id is null"),
    ("unified_payment_intelligence", "not_null_source_account_id", "error", "select count(*) from mart where source_account_id is null"),
    ("unified_payment_intelligence", "relationships_source_account_id", "error", "select count(*) from mart anti join accounts on source_account_id = account_id where source_account_id is not null"),
    ("unified_payment_intelligence", "accepted_values_is_fraud_flag", "warn", "select 0"),
    ("unified_payment_intelligence", "is_after_timestamp", "error", "select count(*) from mart where timestamp < source_opening_date"),
    ("unified_payment_intelligence", "not_null_source_risk_flag", "error", "select count(*) from mart where source_risk_flag is null"),
    ("unified_payment_intelligence", "accepted_values_source_risk_flag", "error", "select 0"),
    ("unified_payment_intelligence", "not_null_destination_risk_flag", "error", "select count(*) from mart where destination_risk_flag is null"),
    ("unified_payment_intelligence", "accepted_values_destination_risk_flag", "error", "select 0"),
    ("unified_payment_intelligence", "fraud_counts_match", "error", "select count(*) from (select 1 where (select count(distinct payment_id) from mart where is_fraud_flag) <> (select count(distinct payment_id) from fraud_cases)) t"),
    ("stg_payments", "unique_payment_id", "error", "select count(*) from (select payment_id from payments group by 1 having count(*) > 1) t"),
    ("stg_payments", "not_null_payment_id", "error", "select count(*) from payments where payment_id is null"),
    ("stg_payments", "amount_not_negative", "warn", "select count(*) from payments where amount < 0"),
    ("stg_accounts", "unique_account_id", "error", "select count(*) from (select account_id from accounts group by 1 having count(*) > 1) t"),
    ("stg_accounts", "not_null_account_id", "error", "select count(*) from accounts where account_id is null"),
    ("stg_risk_feed", "not_null_account_id", "error", "select count(*) from risk_feed_v2 where account_id is null"),
    ("stg_fraud_cases", "unique_payment_id", "error", "select count(*) from (select payment_id from fraud_cases group by 1 having count(*) > 1) t"),
    ("stg_fraud_cases", "not_null_payment_id", "error", "select count(*) from fraud_cases where payment_id is null"),
]


def suite_sql(risk_feed: str) -> str:
    """The report of all declared tests, given the mart and the staged tables as views."""
    counted = [f"select '{t}' as table_name, '{n}' as test_name, '{s}' as severity, ({q}) as failures" for t, n, s, q in _SUITE]
    status = "case when failures <> 0 and severity = 'warn' then 'warn' when failures <> 0 then 'error' else 'pass' end as status"
    return f"select *, {status} from ({' union all '.join(counted)}) r".replace("risk_feed_v2", risk_feed)


@query("test_suite", suite_sql("risk_feed_v2"), "mart risk_feed_v2")
def test_suite(v):
    tables = {
        checks.MART: staged(v.spark, "mart")(v.mart()),
        "stg_payments": staging.stg_payments(v.payments),
        "stg_accounts": staging.stg_accounts(v.accounts),
        "stg_risk_feed": staging.stg_risk_feed(v.risk_feed_v2),
        "stg_fraud_cases": v.stg_fraud_cases,
    }
    return P.run_suite(tables, checks.declared_tests())


@query(
    "source_freshness",
    """select n as source_name, m as max_loaded_at, timestamp '2001-08-01 20:00:00' as snapshotted_at,
              date_diff('second', m, timestamp '2001-08-01 20:00:00') as age_seconds,
              case when n = 'raw_payments' and m < timestamp '2001-08-01 20:00:00' - interval 24 hour then 'error'
                   when n = 'raw_payments' and m < timestamp '2001-08-01 20:00:00' - interval 12 hour then 'warn'
                   when n = 'raw_fraud_cases' and m < timestamp '2001-08-01 20:00:00' - interval 4 day then 'error'
                   when n = 'raw_fraud_cases' and m < timestamp '2001-08-01 20:00:00' - interval 2 day then 'warn'
                   else 'pass' end as status
       from (select 'raw_payments' as n, max(payment_timestamp) as m from payments
             union all select 'raw_fraud_cases', max(cast(fraud_reported_date as timestamp)) from fraud_cases
             where fraud_reported_date < date '2001-07-30') t""",
    "payments fraud_cases",
)
def source_freshness(v):
    now = "2001-08-01 20:00:00"
    paid = P.source_freshness("raw_payments", v.payments, "payment_timestamp", now, P.RAW_FRESHNESS["raw_payments"])
    limits = P.Freshness(filter="fraud_reported_date < date'2001-07-30'")
    cases = P.source_freshness("raw_fraud_cases", v.fraud_cases, F.col("fraud_reported_date"), now, limits)
    return paid.unionByName(cases)


@query(
    "unit_fixture_compare",
    """select account_id, risk_score, 'actual' as actual_or_expected from (select * from risk_feed_v1 except all select * from risk_feed_v2) a
       union all
       select account_id, risk_score, 'expected' from (select * from risk_feed_v2 except all select * from risk_feed_v1) b""",
    "risk_feed_v2",
)
def unit_fixture_compare(v):
    return P.fixture_difference(v.risk_feed_v1, v.risk_feed_v2)
