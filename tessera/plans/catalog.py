"""Sources, sinks and profiles, as round trips over the given tables."""

import datetime

from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.session import fresh_path, load, written
from tessera.sources import profile, readers, writers


@query("preview_customers", """
select c_custkey, c_name, c_acctbal, c_mktsegment from customer order by c_acctbal desc, c_custkey limit 10""")
def preview_customers(spark, d):
    customers = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return readers.preview(customers, 10, [F.desc("c_acctbal"), "c_custkey"])


PROFILED = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
}


@query("column_profile", " union all ".join(
    f"select '{t}' as table_name, {i} as position, '{c}' as column_name, '{k}' as data_type, "
    f"{f'cast(max(length({c})) as integer)' if k == 'string' else 'cast(null as integer)'} as max_length, "
    f"count(*) as row_count, count({c}) as filled_count from {t}"
    for t, columns in PROFILED.items() for i, (c, k) in enumerate(columns, 1)))
def column_profile(spark, d):
    tables = {t: load(spark, d, t) for t in PROFILED}
    return profile.column_profile(tables, [*PROFILED, "no_such_table"], spark)


@query("category_levels", """
select p_type, row_number() over (order by p_type) - 1 as level from (select distinct p_type from part)""")
def category_levels(spark, d):
    return readers.category_levels(load(spark, d, "part"), "p_type")


@query("stringified_orders", """
select coalesce(cast(doc_id as varchar), 'None') as doc_id, source, coalesce(cast(quality as varchar), 'None') as quality,
  coalesce(cast(toxic as varchar), 'None') as toxic
from documents left join labels using (doc_id)""")
def stringified_orders(spark, d):
    joined = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id", "left")
    return writers.stringified(joined.select("doc_id", "source", "quality", "toxic"))


def _delimited(spark, d, delimiter):
    path = fresh_path(spark, "delimited")
    parts = load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    parts.write.option("header", True).option("sep", delimiter).csv(path)
    back = readers.read_delimited(spark, path, delimiter)
    return back.select(F.col("p_partkey").cast("long"), "p_name", "p_brand", "p_size", "p_retailprice")


PART_SQL = "select p_partkey, p_name, p_brand, p_size, p_retailprice from part"


@query("comma_file_round_trip", PART_SQL)
def comma_file(spark, d):
    return _delimited(spark, d, ",")


@query("semicolon_file_round_trip", PART_SQL)
def semicolon_file(spark, d):
    return _delimited(spark, d, ";")


@query("pipe_file_round_trip", PART_SQL)
def pipe_file(spark, d):
    return _delimited(spark, d, "|")


@query("json_records_round_trip", """
select c_name as name, c_custkey as quantity, c_acctbal as purchase_price, c_mktsegment as segment from customer""")
def json_records(spark, d):
    path = fresh_path(spark, "records")
    records = load(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("quantity"),
        F.col("c_acctbal").alias("purchase_price"), F.col("c_mktsegment").alias("segment"))
    writers.save_records(records, path)
    return readers.read_records(spark, path, records.schema, array_file=False)


@query("json_arrays_round_trip", """
select p_partkey as quantity, p_name as name, p_retailprice as purchase_price, p_brand as brand from part""")
def json_arrays(spark, d):
    path = fresh_path(spark, "records")
    records = load(spark, d, "part").select(
        F.col("p_partkey").alias("quantity"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("purchase_price"),
        F.col("p_brand").alias("brand"))
    writers.save_record_arrays(records, path)
    return readers.read_records(spark, path, records.schema).select(*records.columns)


@query("replaced_table", """
select c_mktsegment, count(*) as customers, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
from customer group by 1""")
def replaced_table(spark, d):
    path = fresh_path(spark, "table")
    name = "t_" + path.rsplit("-", 1)[-1]
    totals = load(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
    return writers.replace_table(totals, name, path)


@query("refilled_table", """
select n_name, count(*) as customers from customer join nation on c_nationkey = n_nationkey group by 1""")
def refilled_table(spark, d):
    path = fresh_path(spark, "table")
    name = "t_" + path.rsplit("-", 1)[-1]
    by_nation = load(spark, d, "customer").join(
        load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
    writers.replace_table(by_nation.withColumn("customers", F.col("customers") * 0), name, path)
    return writers.refill_table(written(by_nation), name)


@query("overwritten_partitions", """
select o_orderstatus, o_orderpriority, case when o_orderstatus = 'P' then 2 else 1 end * count(*) as order_count
from orders group by 1, 2""")
def overwritten_partitions(spark, d):
    path = fresh_path(spark, "partitions")
    counts = load(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("order_count"))
    writers.overwrite_partitions(counts, path, ["o_orderstatus"])
    doubled = counts.filter("o_orderstatus = 'P'").withColumn("order_count", F.col("order_count") * 2)
    writers.overwrite_partitions(doubled, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("stamped_orders", """
select o_orderkey, o_totalprice, timestamp '2026-01-01 00:00:00' as insert_timestamp from orders""")
def stamped_orders(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    stamped = writers.stamped(orders, at=datetime.datetime(2026, 1, 1))
    return stamped.withColumn("insert_timestamp", F.col("insert_timestamp").cast("timestamp_ntz"))
