"""Descriptive statistics and panels on the order and line tables."""

from pyspark.sql import functions as F

from tessera.functions.scalar import (
    event_probability, label_number, money, parsed_date, period_key, right_closed_class, safe_ratio)
from tessera.operators import describe
from tessera.operators.quantiles import percentiles
from tessera.plans.registry import query, rounded
from tessera.session import load

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(c, table="lineitem", extra="", group=""):
    return f"""select {extra} '{c}' as variable, count({c}) as n, round(min({c}), 6) as min,
  round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as median, round(avg({c}), 6) as mean,
  round(quantile_cont({c}, 0.75), 6) as q3, round(max({c}), 6) as max, round(stddev_samp({c}), 6) as sd,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) as iqr,
  round(stddev_samp({c}) / avg({c}) * 100, 6) as cv_percent,
  round(avg(({c} - m) ** 3) / any_value(s) ** 3, 6) as skewness, round(kurtosis_pop({c}), 6) as kurtosis
from {table}, (select avg({c}) as m, stddev_pop({c}) as s from {table}) {group}"""


@query("descriptive_summary", " union all ".join(_describe_sql(c) for c in MEASURES))
def descriptive_summary(spark, d):
    return rounded(describe.describe(load(spark, d, "lineitem"), MEASURES))


@query("five_number_summary", " union all ".join(
    f"""select l_returnflag, '{c}' as variable, round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as q1,
  round(quantile_cont({c}, 0.5), 6) as median, round(avg({c}), 6) as mean, round(quantile_cont({c}, 0.75), 6) as q3,
  round(max({c}), 6) as max from lineitem group by l_returnflag""" for c in MEASURES))
def five_number_summary(spark, d):
    return rounded(describe.five_numbers(load(spark, d, "lineitem"), MEASURES, ["l_returnflag"]))


FENCES = """with q as (select event_type as k, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
  quantile_cont(value, 0.75) as q3 from events group by 1),
f as (select *, value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from events join q on event_type = k)
"""


@query("box_statistics", FENCES + """select event_type, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  count(*) as n, round(min(value) filter (where inside), 6) as low_whisker,
  round(max(value) filter (where inside), 6) as high_whisker, count(*) filter (where not inside) as outliers
from f group by event_type, f.q1, f.median, f.q3""")
def box_statistics(spark, d):
    return rounded(describe.box_statistics(load(spark, d, "events"), "value", ["event_type"]))


@query("box_outliers", FENCES + "select event_id, event_type, value from f where not inside")
def box_outliers(spark, d):
    return describe.outliers(load(spark, d, "events").select("event_id", "event_type", "value"), "value", ["event_type"])


@query("frequency_table", """
with c as (select p_size, count(*) as n from part group by 1)
select p_size, n, round(n / (select count(*) from part), 6) as share,
  cast(sum(n) over (order by p_size) as bigint) as cumulative_n,
  round(sum(n) over (order by p_size) / (select count(*) from part), 6) as cumulative_share
from c""")
def frequency_table(spark, d):
    return rounded(describe.frequency_table(load(spark, d, "part"), "p_size"))


PRICE_CLASS = """case when l_extendedprice > 5000 and l_extendedprice <= 93000
  then cast(least(ceil((l_extendedprice - 5000) / 8000), 11) as integer) end"""


def _price_class():
    return right_closed_class(F.col("l_extendedprice"), 5000, 93000, 11)


@query("price_classes", f"""
select {PRICE_CLASS} as price_class, count(*) as n, round(count(*) / (select count(*) from lineitem), 6) as share
from lineitem group by 1""")
def price_classes(spark, d):
    classed = load(spark, d, "lineitem").select(_price_class().alias("price_class"))
    return rounded(describe.class_share(classed, "price_class"))


@query("gini_of_price_classes", f"""
with c as (select {PRICE_CLASS} as k, count(*) as n from lineitem group by 1)
select cast(11 as bigint) as classes,
  round((1 - sum(n * n) filter (where k is not null) / (sum(n) * sum(n))) / (10 / 11), 6) as gini from c""")
def gini_of_price_classes(spark, d):
    classed = load(spark, d, "lineitem").select(_price_class().alias("price_class"))
    return rounded(describe.gini_heterogeneity(classed, "price_class", 11))


@query("gini_of_brands", """
with c as (select p_brand as k, count(*) as n from part group by 1)
select count(k) as classes, round((1 - sum(n * n) / (sum(n) * sum(n))) / ((count(k) - 1) / count(k)), 6) as gini from c""")
def gini_of_brands(spark, d):
    return rounded(describe.gini_heterogeneity(load(spark, d, "part"), "p_brand"))


def nation_panel(spark, d):
    """One row per order: nation, year and month beside the order's own columns."""
    orders = load(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nations = load(spark, d, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                "o_custkey", "o_totalprice")
    )


PANEL = """(select n_name, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
  o_custkey, o_totalprice from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) p"""


@query("panel_ratios", f"""
select n_name, year, month, count(*) as sales, count(distinct o_custkey) as listings,
  round(cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*), 6) as average_price,
  round(count(*) / count(distinct o_custkey), 6) as effectiveness, round(quantile_cont(o_totalprice, 0.5), 6) as median_price
from {PANEL} group by 1, 2, 3""")
def panel_ratios(spark, d):
    panel = nation_panel(spark, d)
    keys = ["n_name", "year", "month"]
    # Distinct customers by two plain aggregations, so a hot nation is combined before each shuffle.
    per_customer = panel.groupBy(*keys, "o_custkey").agg(
        F.count(F.lit(1)).alias("sales"), F.sum(money(F.col("o_totalprice"))).alias("volume"))
    cells = per_customer.groupBy(*keys).agg(
        F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("listings"), F.sum("volume").alias("volume"))
    medians = percentiles(panel, ["o_totalprice"], {"median_price": 0.5}, keys).drop("variable")
    return rounded(cells.join(medians, keys).select(
        *keys, "sales", "listings",
        safe_ratio(F.col("volume").cast("double"), F.col("sales").cast("double")).alias("average_price"),
        safe_ratio(F.col("sales").cast("double"), F.col("listings").cast("double")).alias("effectiveness"),
        "median_price"))


@query("period_totals", f"""
select cast(year as varchar) || lpad(cast(month as varchar), 2, '0') as period,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
  round(cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*), 4) as mean
from {PANEL} group by 1""")
def period_totals(spark, d):
    keyed = nation_panel(spark, d).withColumn("period", period_key(F.col("year"), F.col("month")))
    out = describe.period_totals(keyed, "period", money(F.col("o_totalprice")))
    return out.select("period", F.col("total").cast("double").alias("total"),
                      F.round(F.col("mean").cast("double"), 4).alias("mean"))


NATIONS = ["NATION_1", "NATION_2", "NATION_3", "NATION_4"]


@query("seasonal_profile", f"""
select n_name, month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
  round(cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*), 4) as mean
from {PANEL} where n_name in ('{"', '".join(NATIONS)}') group by 1, 2""")
def seasonal_profile(spark, d):
    out = describe.seasonal_profile(
        nation_panel(spark, d), "n_name", NATIONS, "month", money(F.col("o_totalprice")))
    return out.select("n_name", "month", F.col("total").cast("double").alias("total"),
                      F.round(F.col("mean").cast("double"), 4).alias("mean"))


@query("contingency_table", """
select l_returnflag, l_linestatus, count(*) as n,
  round(count(*) / sum(count(*)) over (partition by l_returnflag), 6) as row_share
from lineitem group by 1, 2""")
def contingency_table(spark, d):
    return rounded(describe.contingency(load(spark, d, "lineitem"), "l_returnflag", "l_linestatus"))


@query("label_counts", """
select 'quality' as label, cast(sum(quality) as bigint) as positives from labels
union all select 'toxic', cast(sum(toxic) as bigint) from labels
union all select '(none)', count(*) from labels where quality + toxic = 0""")
def label_counts(spark, d):
    return describe.label_counts(load(spark, d, "labels"), ["quality", "toxic"])


@query("class_share", """
select event_type, count(*) as n, round(count(*) / (select count(*) from events), 6) as share from events group by 1""")
def class_share(spark, d):
    return rounded(describe.class_share(load(spark, d, "events"), "event_type"))


@query("class_weights", """
select 'quality' as label, round((count(*) - sum(quality)) / sum(quality), 6) as weight from labels
union all select 'toxic', round((count(*) - sum(toxic)) / sum(toxic), 6) from labels""")
def class_weights(spark, d):
    return rounded(describe.class_weights(load(spark, d, "labels"), ["quality", "toxic"]))


@query("correlation_matrix", " union all ".join(
    f"select '{a}' as first, '{b}' as second, round(corr({a}, {b}), 6) as r, round(abs(corr({a}, {b})), 6) as abs_r from lineitem"
    for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]))
def correlation_matrix(spark, d):
    return rounded(describe.correlation_matrix(load(spark, d, "lineitem"), MEASURES))


@query("histogram", """
select cast(least(floor(value / 25), 19) as integer) as bin, count(*) as n from events
where value between 0 and 500 group by 1""")
def histogram(spark, d):
    return describe.histogram(load(spark, d, "events"), F.col("value"), 0, 500, 20)


@query("weighted_histogram", """
select p_brand, cast(greatest(ceil(p_size / 5) - 1, 0) as integer) as bin,
  cast(sum(cast(p_retailprice as decimal(18,2))) as double) as weight from part where p_size between 0 and 50 group by 1, 2""")
def weighted_histogram(spark, d):
    out = describe.histogram(
        load(spark, d, "part"), F.col("p_size"), 0, 50, 10, money(F.col("p_retailprice")), ["p_brand"], right_closed=True)
    return out.withColumn("weight", F.col("weight").cast("double"))


@query("kernel_density", """
with s as (select count(value) as n, min(value) as lo, max(value) as hi,
  0.9 * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34) * count(value) ** -0.2 as bw
  from events),
g as (select n, bw, lo - 3 * bw as low, (hi - lo + 6 * bw) / 511 as step from s),
p as (select floor((value - low) / step) as cell, (value - low) / step - floor((value - low) / step) as part from events, g),
m as (select cell, sum(mass) / (select n from g) as mass from
  (select cell, 1 - part as mass from p union all select cell + 1, part from p) group by 1)
select cast(point as integer) as point, round(any_value(low + point * step), 6) as x,
  round(sum(mass * exp(-0.5 * ((point - cell) * step / bw) ** 2) / (bw * sqrt(2 * pi()))), 6) as density
from m, range(512) as r(point), g group by point""")
def kernel_density(spark, d):
    return rounded(describe.density(load(spark, d, "events"), "value"))


@query("event_probabilities", """
select round(avg(case when event_type = 'purchase' then 1.0 else 0.0 end), 6) as purchase,
  round(avg(case when month(ts) = 1 then 1.0 else 0.0 end), 6) as in_january,
  round(avg(case when event_type = 'purchase' and month(ts) = 1 then 1.0 else 0.0 end), 6) as both
from events""")
def event_probabilities(spark, d):
    purchase, january = F.col("event_type") == "purchase", F.month("ts") == 1
    return rounded(load(spark, d, "events").agg(
        event_probability(purchase).alias("purchase"), event_probability(january).alias("in_january"),
        event_probability(purchase & january).alias("both")))


@query("parsed_dates", """
select event_id, try_cast(left(cast(ts as varchar), 10) as date) as day,
  try_strptime(event_type, '%Y-%m-%d %H:%M:%S') is null as unreadable from events""")
def parsed_dates(spark, d):
    events = load(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"), "event_type")
    return events.select("event_id", parsed_date(F.col("text")).alias("day"),
                         parsed_date(F.col("event_type")).isNull().alias("unreadable"))


@query("label_numbers", """
select event_id, case event_type when 'view' then 0 when 'click' then 1 end as number from events""")
def label_numbers(spark, d):
    return load(spark, d, "events").select(
        "event_id", label_number(F.col("event_type"), {"view": 0, "click": 1}).alias("number"))


@query("filtered_lines", """
select l_orderkey as order_key, l_linenumber, l_shipdate, l_quantity from lineitem
where l_returnflag in ('R', 'A') and l_quantity >= 45 and not (l_discount < 0.05)""")
def filtered_lines(spark, d):
    lines = load(spark, d, "lineitem").filter(
        F.col("l_returnflag").isin("R", "A") & (F.col("l_quantity") >= 45) & ~(F.col("l_discount") < 0.05))
    return lines.withColumnRenamed("l_orderkey", "order_key").select("order_key", "l_linenumber", "l_shipdate", "l_quantity")


@query("date_limits", """
select min(cast(o_orderdate as date)) as first_day, max(cast(o_orderdate as date)) as last_day, count(*) as row_count from orders""")
def date_limits(spark, d):
    return load(spark, d, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.count(F.lit(1)).alias("row_count"))
