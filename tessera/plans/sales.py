"""Cross-selling rules and daily sales forecasts."""

import datetime

from pyspark.sql import DataFrame, functions as F

from tessera.functions.scalar import money
from tessera.operators import baskets, describe, series
from tessera.plans.registry import query, rounded
from tessera.session import load, written
from tessera.sources.writers import stamped

# The defaults of the scheduled job.
MIN_COUNT, MIN_CONFIDENCE, SPAN = 10, 0.005, 7


def refresh_sales(
    invoices: DataFrame, document: str, item: str, day: str, amount: str, *,
    min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE, span: int = SPAN,
    at: datetime.datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The daily job: (stamped pair rules by confidence, stamped forecast of the next days).

    Customer and product tables take part in neither result, so they are not joined.
    """
    rules = baskets.pair_rules(invoices, document, item, min_count, min_confidence)
    daily = series.regular_daily_series(invoices.withColumn("_day", F.to_date(day)), "_day", money(F.col(amount)))
    keyed = written(daily, "daily").withColumn("series", F.lit("all"))
    predicted = series.forecast(keyed, span, ["series"]).drop("series")
    return stamped(rules, at=at).orderBy(F.desc("confidence")), stamped(predicted, at=at)


def invoice_lines(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    parts = load(spark, d, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "l_orderkey", "p_brand", "l_extendedprice")


ITEMS = """i as (select distinct l_orderkey as doc, p_brand as item from lineitem left join part on l_partkey = p_partkey
  where p_brand is not null), n as (select count(distinct l_orderkey) as total from lineitem),
c as (select item, count(*) as n from i group by 1)"""


@query("baskets", """
select l_orderkey as document, list_sort(list(distinct p_brand)) as items
from lineitem left join part on l_partkey = p_partkey group by 1""")
def all_baskets(spark, d):
    return baskets.baskets(invoice_lines(spark, d), "l_orderkey", "p_brand")


@query("distinct_items", "select distinct l_orderkey as document, l_partkey as item from lineitem")
def distinct_items(spark, d):
    return baskets.basket_items(load(spark, d, "lineitem"), "l_orderkey", "l_partkey")


@query("basket_count", "select count(distinct l_orderkey) as baskets from lineitem")
def basket_count(spark, d):
    return baskets.basket_count(load(spark, d, "lineitem"), "l_orderkey")


PAIR_SQL = f"""with {ITEMS}, p as (select a.item as antecedent, b.item as consequent, count(*) as n
  from i a join i b on a.doc = b.doc and a.item <> b.item group by 1, 2 having count(*) >= {{low}})
select antecedent, consequent, round(p.n / a.n, 6) as confidence, round((p.n / a.n) / (b.n / total), 6) as lift,
  round(p.n / total, 6) as support
from p join c a on a.item = antecedent join c b on b.item = consequent, n where p.n / a.n >= {MIN_CONFIDENCE}"""


@query("brand_pair_rules", PAIR_SQL.format(low=MIN_COUNT))
def brand_pair_rules(spark, d):
    return rounded(baskets.pair_rules(invoice_lines(spark, d), "l_orderkey", "p_brand", MIN_COUNT, MIN_CONFIDENCE))


@query("brand_pair_rules_from_miner", PAIR_SQL.format(low=MIN_COUNT))
def brand_pair_rules_from_miner(spark, d):
    return rounded(baskets.mined_pair_rules(invoice_lines(spark, d), "l_orderkey", "p_brand", MIN_COUNT, MIN_CONFIDENCE))


def _itemsets_sql(largest: int) -> str:
    """Itemsets of up to ``largest`` items by joins of the distinct pairs."""
    parts = [f"select [item] as items, n from c where n >= {MIN_COUNT}"]
    for size in range(2, largest + 1):
        joins = " ".join(f"join i i{k} on i{k}.doc = i1.doc and i{k - 1}.item < i{k}.item" for k in range(2, size + 1))
        items = ", ".join(f"i{k}.item" for k in range(1, size + 1))
        parts.append(f"select [{items}], count(*) from i i1 {joins} group by 1 having count(*) >= {MIN_COUNT}")
    return f"with {ITEMS} " + " union all ".join(parts)


@query("frequent_itemsets", _itemsets_sql(7))
def frequent_itemsets(spark, d):
    return baskets.frequent_itemsets(invoice_lines(spark, d), "l_orderkey", "p_brand", MIN_COUNT)


@query("top_pair_rules", PAIR_SQL.format(low=MIN_COUNT) + " order by confidence desc, antecedent, consequent limit 25")
def top_pair_rules(spark, d):
    return brand_pair_rules(spark, d).orderBy(F.desc("confidence"), "antecedent", "consequent").limit(25)


def daily_orders(spark, d):
    return load(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey", "o_totalprice")


def nation_series(spark, d):
    customers = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = daily_orders(spark, d).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return series.regular_daily_series(orders, "day", money(F.col("o_totalprice")), ["c_nationkey"])


def _double(df):
    return df.withColumn("total_amount", F.col("total_amount").cast("double"))


O = "(select cast(o_orderdate as date) as day, o_custkey, cast(o_totalprice as decimal(18,2)) as amount from orders)"
LAST_YEAR = f"y as (select * from {O} where day >= (select max(day) - interval 1 year from {O}))"
TOTAL = f"""{LAST_YEAR}, s as (select g.day as date, cast(coalesce(sum(amount), 0) as double) as total_amount
  from (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from y) g
  left join y on y.day = g.day group by 1)"""
BY_NATION = f"""{LAST_YEAR}, k as (select distinct c_nationkey from y join customer on o_custkey = c_custkey),
g as (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from y),
t as (select c_nationkey, day, sum(amount) as amount from y join customer on o_custkey = c_custkey group by 1, 2),
s as (select k.c_nationkey, g.day as date, cast(coalesce(amount, 0) as double) as total_amount
  from k cross join g left join t on t.c_nationkey = k.c_nationkey and t.day = g.day)"""


@query("daily_totals", f"select day as date, cast(sum(amount) as double) as total_amount from {O} group by 1")
def daily_totals(spark, d):
    return _double(series.daily_totals(daily_orders(spark, d), "day", money(F.col("o_totalprice"))))


@query("trailing_year_orders", f"with {LAST_YEAR} select day, count(*) as order_count from y group by 1")
def trailing_year_orders(spark, d):
    return series.trailing_year(daily_orders(spark, d), "day").groupBy("day").agg(F.count(F.lit(1)).alias("order_count"))


@query("regular_daily_series", f"with {TOTAL} select * from s")
def regular_daily_series(spark, d):
    return _double(series.regular_daily_series(daily_orders(spark, d), "day", money(F.col("o_totalprice"))))


@query("gap_filled_nation_series", f"with {BY_NATION} select * from s")
def gap_filled_nation_series(spark, d):
    return _double(nation_series(spark, d))


@query("future_dates", f"""
with {BY_NATION} select c_nationkey, cast(l + interval (h) day as date) as date
from (select c_nationkey, max(date) as l from s group by 1), range(1, {SPAN + 1}) as r(h)""")
def future_dates(spark, d):
    return series.future_dates(nation_series(spark, d), SPAN, ["c_nationkey"])


@query("series_with_future_rows", f"""
with {BY_NATION} select * from s union all select c_nationkey, cast(l + interval (h) day as date), 0::double
from (select c_nationkey, max(date) as l from s group by 1), range(1, {SPAN + 1}) as r(h)""")
def series_with_future_rows(spark, d):
    return _double(series.with_future_rows(nation_series(spark, d), SPAN, ["c_nationkey"]))


@query("holdout_days", f"""
with {BY_NATION}, r as (select *, row_number() over (partition by c_nationkey order by date desc) <= {SPAN} as late from s)
select c_nationkey, case when late then 'test' else 'train' end as part, count(*) as day_count,
  min(date) as first_day, max(date) as last_day from r group by 1, 2""")
def holdout_days(spark, d):
    train, test = series.holdout_split(nation_series(spark, d), SPAN, ["c_nationkey"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("c_nationkey", "part").agg(
        F.count(F.lit(1)).alias("day_count"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("series_differences", f"""
with {BY_NATION} select c_nationkey, date, total_amount,
  round(total_amount - lag(total_amount, 1) over w, 2) as difference,
  round(total_amount - lag(total_amount, 7) over w, 2) as seasonal_difference
from s window w as (partition by c_nationkey order by date)""")
def series_differences(spark, d):
    out = series.differences(_double(nation_series(spark, d)), ["c_nationkey"])
    return out.withColumns({c: F.round(c, 2) for c in ("difference", "seasonal_difference")})


@query("seasonal_naive_forecast", f"""
with {BY_NATION}, l as (select c_nationkey, max(date) as last from s group by 1)
select s.c_nationkey, cast(last + interval (h) day as date) as date, total_amount as predicted_sales
from l cross join range(1, 15) as r(h) join s on s.c_nationkey = l.c_nationkey
  and s.date = cast(last + interval (h - 7 * cast(ceil(h / 7) as integer)) day as date)""")
def seasonal_naive_forecast(spark, d):
    return series.seasonal_naive(_double(nation_series(spark, d)), 14, ["c_nationkey"])


@query("seasonal_arima_forecast")
def seasonal_arima_forecast(spark, d):
    return series.forecast(nation_series(spark, d), SPAN, ["c_nationkey"])


@query("daily_sales_refresh")
def daily_sales_refresh(spark, d):
    lines = invoice_lines(spark, d).join(
        load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    rules, predicted = refresh_sales(
        lines, "l_orderkey", "p_brand", "o_orderdate", "l_extendedprice", at=datetime.datetime(2026, 1, 1))
    described = rules.select(F.lit("rule").alias("kind"), F.concat_ws(" -> ", "antecedent", "consequent").alias("name"),
                             F.col("confidence").alias("value"))
    return described.unionByName(predicted.select(
        F.lit("forecast").alias("kind"), F.col("date").cast("string").alias("name"), F.col("predicted_sales").alias("value")))


GROSS = "cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))"


@query("profit_totals", f"""
select cast(sum({GROSS}) as double) as gross, cast(sum({GROSS} - cast(l_quantity as decimal(18,2))) as double) as net
from lineitem""")
def profit_totals(spark, d):
    gross = money(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    out = describe.totals(load(spark, d, "lineitem"), {"gross": gross, "net": gross - money(F.col("l_quantity"))})
    return out.select(*[F.col(c).cast("double").alias(c) for c in out.columns])
