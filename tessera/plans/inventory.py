"""Inventory ledger on events as sale lines and parts as stock."""

from pyspark.sql import functions as F

from tessera.functions.scalar import money
from tessera.operators import ledger
from tessera.plans.registry import query, rounded
from tessera.session import load, written
from tessera.streaming import runs
from tessera.streaming.daily import DailyTotals
from tessera.streaming.sales import SalesStream

LINE = """select event_id as line, user_id * 1000 + dayofyear(ts) as sale,
  cast(json_extract_string(props, '$.k') as bigint) as product, cast(floor(value) as bigint) as quantity from events"""
STOCK = """select p_partkey as product, cast(p_size as bigint) * 40 as quantity, p_retailprice * 0.75::double as purchase_price,
  p_retailprice as selling_price from part"""


def as_lines(events):
    return events.select(
        F.col("event_id").alias("line"), (F.col("user_id") * 1000 + F.dayofyear("ts")).alias("sale"),
        F.get_json_object("props", "$.k").cast("long").alias("product"), F.floor("value").cast("long").alias("quantity"))


def sale_lines(spark, d):
    return as_lines(load(spark, d, "events"))


def stock(spark, d):
    return load(spark, d, "part").select(
        F.col("p_partkey").alias("product"), (F.col("p_size").cast("long") * 40).alias("quantity"),
        (F.col("p_retailprice") * 0.75).alias("purchase_price"), F.col("p_retailprice").alias("selling_price"))


LEDGER = f"""with recursive stock as ({STOCK}), sales as ({LINE}),
stops as (select sale, min(line) as stop from sales where quantity <= 0 group by 1),
marked as (select s.*, case when line > stop then 'aborted' when quantity <= 0 then 'bad_quantity' end as early
  from sales s left join stops using (sale)),
live as (select m.product, line, m.quantity, row_number() over (partition by m.product order by line) as i
  from marked m semi join stock using (product) where early is null),
fold(product, i, line, available, ok, remaining) as (
  select product, cast(0 as bigint), cast(null as bigint), cast(null as bigint), false, quantity from stock
  union all select l.product, l.i, l.line, f.remaining, l.quantity <= f.remaining,
    case when l.quantity <= f.remaining then f.remaining - l.quantity else f.remaining end
  from fold f join live l on l.product = f.product and l.i = f.i + 1),
decided as (select m.line, m.sale, m.product, m.quantity,
  case when early is not null then early when ok then 'ok' when ok is null or available = 0 then 'unknown_product'
    else 'insufficient' end as status, available,
  case when early is null and ok then m.quantity * selling_price end as gross_profit,
  case when early is null and ok then m.quantity * selling_price - m.quantity * purchase_price end as net_profit
  from marked m left join (select * from fold where line is not null) f on f.line = m.line left join stock s on s.product = m.product)
"""
DECIDED = LEDGER + """select line, sale, product, quantity, status, available, round(gross_profit, 4) as gross_profit,
  round(net_profit, 4) as net_profit from decided"""


@query("sale_acceptance", DECIDED)
def sale_acceptance(spark, d):
    return rounded(ledger.accept_sales(sale_lines(spark, d), stock(spark, d)), 4)


@query("streamed_sale_acceptance", DECIDED)
def streamed_sale_acceptance(spark, d):
    none = F.lit(None).cast("double")
    lines = as_lines(runs.table_stream(spark, d, "events")).withColumns(
        {"delivered": F.lit(False), "purchase_price": none, "selling_price": none})
    decided = SalesStream(stock(spark, d)).run(lines)
    return rounded(decided.drop("delivered", "purchase_price", "selling_price"), 4)


def interleaved(spark, d):
    """Sign-ups are deliveries of their value in units, all other events are sale lines."""
    delivered = F.col("event_type") == "signup"
    price = F.when(delivered, (F.col("event_id") % 97 + 1).cast("double"))
    return load(spark, d, "events").select(
        F.when(~delivered, F.col("user_id") * 1000 + F.dayofyear("ts")).alias("sale"), F.col("event_id").alias("line"),
        F.get_json_object("props", "$.k").cast("long").alias("product"), F.floor("value").cast("long").alias("quantity"),
        delivered.alias("delivered"), price.alias("purchase_price"), (price * 1.5).alias("selling_price"))


def small_stock(spark, d):
    """Half of the products, few units of each."""
    return load(spark, d, "part").filter("p_partkey % 2 = 0").select(
        F.col("p_partkey").alias("product"), F.col("p_size").cast("long").alias("quantity"),
        (F.col("p_retailprice") * 0.75).alias("purchase_price"), F.col("p_retailprice").alias("selling_price"))


#: Every product's lines in order, one recursion step a line; a product leaves the list at 0 and is listed anew by a delivery.
INTERLEAVED = """with recursive stock as (
  select p_partkey as product, cast(p_size as bigint) as quantity, p_retailprice * 0.75::double as purchase_price,
    p_retailprice as selling_price from part where p_partkey % 2 = 0),
events_ as (select case when event_type <> 'signup' then user_id * 1000 + dayofyear(ts) end as sale, event_id as line,
    cast(json_extract_string(props, '$.k') as bigint) as product, cast(floor(value) as bigint) as quantity,
    event_type = 'signup' as delivered, cast(event_id % 97 + 1 as double) as price from events),
stops as (select sale, min(line) as stop from events_ where quantity <= 0 and not delivered group by 1),
marked as (select e.*, case when line > stop then 'aborted' when quantity <= 0 then 'bad_quantity' end as early
  from events_ e left join stops using (sale)),
known as (select product from stock union select product from marked where delivered and early is null),
live as (select m.*, row_number() over (partition by m.product order by line) as i from marked m semi join known using (product)
  where early is null),
fold(product, i, line, available, status, remaining, purchase_price, selling_price) as (
  select k.product, cast(0 as bigint), cast(null as bigint), cast(null as bigint), '', coalesce(s.quantity, 0), s.purchase_price,
    s.selling_price from known k left join stock s using (product)
  union all select l.product, l.i, l.line, f.remaining,
    case when delivered then case when f.remaining = 0 then 'listed' else 'added' end when f.remaining = 0 then 'unknown_product'
      when l.quantity <= f.remaining then 'ok' else 'insufficient' end,
    case when delivered then f.remaining + l.quantity when l.quantity <= f.remaining then f.remaining - l.quantity else f.remaining end,
    case when delivered and f.remaining = 0 then price else f.purchase_price end,
    case when delivered and f.remaining = 0 then price * 1.5::double else f.selling_price end
  from fold f join live l on l.product = f.product and l.i = f.i + 1),
"""
SETTLED = INTERLEAVED + """decided as (select m.line, m.sale, m.product, m.quantity, m.delivered,
    coalesce(early, f.status, 'unknown_product') as status, f.available, f.purchase_price, f.selling_price
  from marked m left join (select * from fold where line is not null) f on f.line = m.line)
select line, sale, product, quantity, delivered, status, case when status <> 'unknown_product' then available end as available,
  round(case when status in ('ok', 'added', 'listed') then purchase_price end, 4) as purchase_price,
  round(case when status in ('ok', 'added', 'listed') then selling_price end, 4) as selling_price,
  round(case when status = 'ok' then quantity * selling_price end, 4) as gross_profit,
  round(case when status = 'ok' then quantity * selling_price - quantity * purchase_price end, 4) as net_profit from decided"""


def listed_lines(settled):
    """Prices only where the line moved stock; the stock of products that are not listed is not shown."""
    moved = F.col("status").isin("ok", "added", "listed")
    return rounded(settled.withColumns({
        "available": F.when(F.col("status") != "unknown_product", F.col("available")),
        **{name: F.when(moved, F.col(name)) for name in ("purchase_price", "selling_price")}}), 4)


@query("deliveries_between_sales", SETTLED)
def deliveries_between_sales(spark, d):
    return listed_lines(ledger.settle(interleaved(spark, d), small_stock(spark, d)))


@query("streamed_deliveries_between_sales", SETTLED)
def streamed_deliveries_between_sales(spark, d):
    arriving = runs.ordered_stream(interleaved(spark, d), "line", batches=4)
    return listed_lines(SalesStream(small_stock(spark, d)).run(arriving))


@query("closing_stock", INTERLEAVED + """last as (select product, arg_max(remaining, i) as remaining,
    arg_max(struct_pack(p := purchase_price, s := selling_price), i) as prices from fold group by 1)
select product, remaining as quantity, round(prices.p, 4) as purchase_price, round(prices.s, 4) as selling_price from last
where remaining > 0""")
def closing_stock(spark, d):
    settled = written(ledger.settle(interleaved(spark, d), small_stock(spark, d)), "settled")
    return rounded(ledger.closing_stock(small_stock(spark, d), settled), 4)


@query("remaining_stock", LEDGER + """select p.product, p.quantity - coalesce(sold, 0) as quantity, round(purchase_price, 4) as purchase_price,
  selling_price from stock p left join (select product, cast(sum(quantity) as bigint) as sold from decided where status = 'ok' group by 1) using (product)
  where p.quantity - coalesce(sold, 0) > 0""")
def remaining_stock(spark, d):
    decided = written(ledger.accept_sales(sale_lines(spark, d), stock(spark, d)), "decided")
    return ledger.remaining_stock(stock(spark, d), decided).withColumn("purchase_price", F.round("purchase_price", 4))


@query("sale_totals", LEDGER + """select sale, round(coalesce(sum(gross_profit), 0), 2) as total,
  count(*) filter (where status = 'ok') as ok_lines, count(*) filter (where status = 'insufficient') as insufficient_lines,
  count(*) filter (where status = 'unknown_product') as unknown_product_lines,
  count(*) filter (where status = 'bad_quantity') as bad_quantity_lines, count(*) filter (where status = 'aborted') as aborted_lines
from decided group by 1""")
def sale_totals(spark, d):
    return rounded(ledger.sale_totals(ledger.accept_sales(sale_lines(spark, d), stock(spark, d))), 2)


@query("stock_after_deliveries", f"""with s as ({STOCK}),
l as (select l_partkey * 2 as product, cast(sum(l_quantity) as bigint) as added from lineitem where l_quantity > 0 group by 1)
select coalesce(s.product, l.product) as product, coalesce(quantity, 0) + coalesce(added, 0) as quantity,
  round(case when s.product is null then l.product / 2 else purchase_price end, 4) as purchase_price,
  round(case when s.product is null then cast(l.product as double) else selling_price end, 4) as selling_price
from s full join l on s.product = l.product""")
def stock_after_deliveries(spark, d):
    deliveries = load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("line"), (F.col("l_partkey") * 2).alias("product"), F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_partkey").cast("double").alias("purchase_price"), (F.col("l_partkey") * 2).cast("double").alias("selling_price"))
    return rounded(ledger.add_products(stock(spark, d), deliveries), 4)


@query("streamed_daily_totals", """
select cast(ts as date) as date, cast(sum(cast(value as decimal(18,2))) as double) as total_amount from events group by 1""")
def streamed_daily_totals(spark, d):
    """Every seventh event arrives two days late, every eleventh comes a second time a day after the first."""
    events = load(spark, d, "events").select("event_id", "ts", "value")
    delay = F.when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    day = F.unix_seconds(F.col("ts").cast("timestamp")) / 86400
    once = events.withColumn("arrival", day + delay)
    again = once.filter("event_id % 11 = 0").withColumn("arrival", F.col("arrival") + 1)
    arriving = runs.ordered_stream(once.unionByName(again), "arrival", batches=5)
    totals = DailyTotals(spark, late="5 days").run(arriving, "ts", money(F.col("value")), "event_id")
    return totals.withColumn("total_amount", F.col("total_amount").cast("double"))
