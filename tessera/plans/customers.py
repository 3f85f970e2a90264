"""Customer feature table and data-quality checks on customer <- orders <- lineitem."""

from pyspark.sql import functions as F

from tessera.functions.scalar import completed_years, money, zero_if_null
from tessera.operators import features, quality
from tessera.plans.registry import query
from tessera.session import load

# Four known account types; "5-LOW" stays an unknown type on purpose.
TYPES = {"1-URGENT": "base", "2-HIGH": "business", "3-MEDIUM": "private", "4-NOT SPECIFIED": "family"}
SIGNS = {"O": "in", "F": "out"}
AMOUNT = "cast(l_extendedprice as decimal(18,2))"


def _total(condition=None):
    return f"sum({AMOUNT}) filter (where {condition})"


def _amount(condition, name):
    return f"coalesce(cast({_total(condition)} as double), 0) as {name}"


def _count(condition, name):
    return f"cast(count(*) filter (where {condition}) as bigint) as {name}"


def _signed():
    parts = []
    for value, name in SIGNS.items():
        parts += [_count(f"l_linestatus = '{value}'", f"{name}_count"),
                  _amount(f"l_linestatus = '{value}'", f"{name}_amount")]
    return parts


def _crossed():
    parts = []
    for s, s_name in SIGNS.items():
        for t, t_name in TYPES.items():
            hit = f"l_linestatus = '{s}' and o_orderpriority = '{t}'"
            parts += [_count(hit, f"{s_name}_count_{t_name}"), _amount(hit, f"{s_name}_amount_{t_name}")]
    return parts


def _accounts():
    return ["cast(count(*) as bigint) as accounts_total"] + [
        _count(f"o_orderpriority = '{v}'", f"accounts_{n}") for v, n in TYPES.items()]


def _as_double(df):
    return df.select(*[
        zero_if_null(F.col(c)).cast("double").alias(c) if "amount" in c else F.col(c) for c in df.columns])


def _movements(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_extendedprice")
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return features.star_join(lines, [(orders, "l_orderkey", "o_orderkey")])


JOINED = "from lineitem left join orders on l_orderkey = o_orderkey"


@query("customer_features", f"""
with a as (select o_custkey, {', '.join(_accounts())} from orders group by 1),
m as (select o_custkey, {', '.join(_signed() + _crossed())} {JOINED} group by 1)
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  {', '.join(f"coalesce({e.split(' as ')[-1]}, 0) as {e.split(' as ')[-1]}" for e in _accounts() + _signed() + _crossed())}
from customer left join a on c_custkey = a.o_custkey left join m on c_custkey = m.o_custkey
""")
def customer_features(spark, d):
    return features.customer_features(
        load(spark, d, "customer"), load(spark, d, "orders"), load(spark, d, "lineitem"),
        customer_key="c_custkey", account_owner="o_custkey", account_key="o_orderkey",
        movement_account="l_orderkey", account_type="o_orderpriority", types=TYPES,
        sign="l_linestatus", signs=SIGNS, amount="l_extendedprice",
    )


@query("signed_totals_by_customer", f"select o_custkey, {', '.join(_signed())} {JOINED} group by 1")
def signed_totals(spark, d):
    return _as_double(features.signed_totals(
        _movements(spark, d), ["o_custkey"], "l_linestatus", money(F.col("l_extendedprice")), SIGNS))


@query("accounts_by_type", f"select o_custkey, {', '.join(_accounts())} from orders group by 1")
def accounts_by_type(spark, d):
    return features.accounts_by_type(load(spark, d, "orders"), ["o_custkey"], "o_orderpriority", TYPES)


@query("sign_by_type_pivot", f"select o_custkey, {', '.join(_crossed())} {JOINED} group by 1")
def sign_by_type(spark, d):
    return _as_double(features.sign_by_type(
        _movements(spark, d), ["o_custkey"], "l_linestatus", "o_orderpriority",
        money(F.col("l_extendedprice")), SIGNS, TYPES))


@query("completed_years", """
select o_orderkey, cast(2026 - year(o_orderdate)
  - case when 101 < month(o_orderdate) * 100 + day(o_orderdate) then 1 else 0 end as integer) as age
from orders""")
def ages(spark, d):
    return load(spark, d, "orders").select(
        "o_orderkey", completed_years(F.col("o_orderdate"), F.lit("2026-01-01").cast("date")).alias("age"))


@query("zero_filled_toxicity", """
select d.doc_id, coalesce(l.toxic, 0) as toxic, coalesce(l.quality, 0) as quality
from documents d left join labels l using (doc_id)""")
def zero_filled(spark, d):
    documents = load(spark, d, "documents").select("doc_id")
    return documents.join(load(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", zero_if_null(F.col("toxic")).alias("toxic"), zero_if_null(F.col("quality")).alias("quality"))


@query("star_join_revenue", """
select n_name, c_mktsegment, p_brand, count(*) as line_count,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount
from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey left join part on l_partkey = p_partkey
group by 1, 2, 3""")
def star_join_revenue(spark, d):
    star = features.star_join(load(spark, d, "lineitem"), [
        (load(spark, d, "orders"), "l_orderkey", "o_orderkey"),
        (load(spark, d, "customer"), "o_custkey", "c_custkey"),
        (load(spark, d, "nation"), "c_nationkey", "n_nationkey"),
        (load(spark, d, "part"), "l_partkey", "p_partkey"),
    ])
    return star.groupBy("n_name", "c_mktsegment", "p_brand").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(money(F.col("l_extendedprice"))).cast("double").alias("amount"))


@query("left_join_using_key", """
select doc_id, source, lang, quality, toxic from documents left join labels using (doc_id)""")
def left_join_using(spark, d):
    return load(spark, d, "documents").select("doc_id", "source", "lang").join(
        load(spark, d, "labels"), "doc_id", "left")


@query("duplicate_line_keys", """
select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""")
def duplicate_line_keys(spark, d):
    return quality.duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_label_keys", """
select d.doc_id, d.source, l.quality, l.toxic from documents d left join labels l using (doc_id)
where l.quality is null or l.toxic is null""")
def null_label_keys(spark, d):
    joined = load(spark, d, "documents").select("doc_id", "source").join(
        load(spark, d, "labels"), "doc_id", "left")
    return quality.null_keys(joined, ["quality", "toxic"])


@query("join_cardinality", """
select 'orders' as dimension, (select count(*) from lineitem) as rows_before, count(*) as rows_after,
  count(*) filter (where o_orderkey is null) as rows_unmatched
from lineitem left join orders on l_orderkey = o_orderkey
union all select 'part', (select count(*) from lineitem), count(*), count(*) filter (where p_partkey is null)
from lineitem left join part on l_partkey = p_partkey
union all select 'lines_of_supplier', (select count(*) from supplier), count(*), count(*) filter (where l_suppkey is null)
from supplier left join lineitem on s_suppkey = l_suppkey""")
def join_cardinality(spark, d):
    lines = load(spark, d, "lineitem")
    to_orders = quality.join_cardinality(lines, {
        "orders": (load(spark, d, "orders"), "l_orderkey", "o_orderkey"),
        "part": (load(spark, d, "part"), "l_partkey", "p_partkey"),
    })
    return to_orders.unionByName(quality.join_cardinality(load(spark, d, "supplier"), {
        "lines_of_supplier": (lines, "s_suppkey", "l_suppkey")}))


@query("quarantined_quantities", """
select 'suspicious' as status, count(*) as line_count, cast(min(l_quantity) as double) as lowest from lineitem where l_quantity < 10
union all select 'kept', count(*), cast(min(l_quantity) as double) from lineitem where not coalesce(l_quantity < 10, false)""")
def quarantined_quantities(spark, d):
    suspicious, kept = quality.quarantined(load(spark, d, "lineitem"), F.col("l_quantity") < 10)

    def report(df, status):
        return df.agg(F.count(F.lit(1)).alias("line_count"), F.min("l_quantity").alias("lowest")).select(
            F.lit(status).alias("status"), "*")

    return report(suspicious, "suspicious").unionByName(report(kept, "kept"))


EDGES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "N:1"),
    ("orders", "o_custkey", "customer", "c_custkey", "N:1"),
    ("nation", "n_regionkey", "region", "r_regionkey", "N:1"),
    ("labels", "doc_id", "documents", "doc_id", "1:1"),
    ("part", "p_partkey", "lineitem", "l_partkey", "1:1"),
    ("customer", "c_code", "orders", "o_custkey", "1:N"),
]


def _edge_sql(t1, c1, t2, c2, declared):
    if c1 == "c_code":
        return (f"select '{t1}' as table1, '{c1}' as column1, '{t2}' as table2, '{c2}' as column2, "
                f"'{declared}' as declared_type, null as observed_type, null as unmatched_keys1, "
                "null as unmatched_keys2, 'column not found' as note")
    return f"""select '{t1}' as table1, '{c1}' as column1, '{t2}' as table2, '{c2}' as column2,
  '{declared}' as declared_type,
  (case when max(n1) > 1 then 'N' else '1' end) || ':' || (case when max(n2) > 1 then 'N' else '1' end) as observed_type,
  count(*) filter (where n2 is null) as unmatched_keys1, count(*) filter (where n1 is null) as unmatched_keys2,
  null as note
from (select {c1} as k, count(*) as n1 from {t1} where {c1} is not null group by 1) a
full join (select {c2} as k, count(*) as n2 from {t2} where {c2} is not null group by 1) b on a.k = b.k"""


@query("relationship_check", " union all ".join(_edge_sql(*e) for e in EDGES))
def relationship_check(spark, d):
    names = {e[0] for e in EDGES} | {e[2] for e in EDGES}
    return quality.relationship_check({n: load(spark, d, n) for n in names}, EDGES)
