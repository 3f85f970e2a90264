import random
import time

import numpy as np
import pandas as pd
import pytest

from tessera.operators import ledger, stock_functions
from tessera.streaming import sales
from tessera.streaming.sales import SalesStream


def brute(sales, stock):
    left = {p: q for p, q, _, _ in stock}
    listed = set(left)
    stopped, out = set(), {}
    for sale, line, product, quantity in sorted(sales, key=lambda r: r[1]):
        if sale in stopped:
            out[line] = "aborted"
        elif quantity is None or quantity <= 0:
            out[line] = "bad_quantity"
            stopped.add(sale)
        elif product not in listed or left[product] == 0:
            out[line] = "unknown_product"
        elif quantity > left[product]:
            out[line] = "insufficient"
        else:
            left[product] -= quantity
            out[line] = "ok"
    return out, {p: q for p, q in left.items() if q > 0}


def random_sales(n=1500):
    rng = random.Random(11)
    rows = [(i // 4, i, "hot" if i % 3 else f"p{rng.randrange(5)}", rng.choice([1, 2, 3, 5, 40, 90, 200, 600])) for i in range(n)]
    rows[40] = (10, 40, "hot", 0)
    rows[101] = (25, 101, "p1", -2)
    rows[200] = (50, 200, "ghost", 1)
    return rows


STOCK = [("hot", 1023, 1.0, 2.0), ("p0", 300, 1.0, 1.5), ("p1", 7, 2.0, 1.0), ("p2", 0, 1.0, 2.0), ("p3", 100_000, 1.0, 2.0), ("p4", 64, 1.0, 2.0)]
SALES_SCHEMA = "sale long, line long, product string, quantity long"
STOCK_SCHEMA = "product string, quantity long, purchase_price double, selling_price double"


@pytest.mark.parametrize("slice_rows", [20, 100, 10**6])
def test_acceptance_matches_a_plain_loop(spark, slice_rows):
    rows = random_sales()
    sales, stock = spark.createDataFrame(rows, SALES_SCHEMA), spark.createDataFrame(STOCK, STOCK_SCHEMA)
    decided = ledger.accept_sales(sales, stock, slice_rows)
    wanted, left = brute(rows, STOCK)
    assert {r["line"]: r["status"] for r in decided.collect()} == wanted
    assert {r["product"]: r["quantity"] for r in ledger.remaining_stock(stock, decided).collect()} == left


def test_slices_with_adversarial_quantities(spark):
    rows = [(i, i, "p", q) for i, q in enumerate([100, 1, 100, 1, 99, 1, 98, 50, 49, 48, 1, 47, 20, 27, 3, 7, 1, 1, 1, 64, 0 + 2, 1] * 3)]
    stock = [("p", 100 + 1, 1.0, 2.0)]
    for start in (101, 64, 63, 1):
        stock = [("p", start, 1.0, 2.0)]
        decided = ledger.accept_sales(spark.createDataFrame(rows, SALES_SCHEMA), spark.createDataFrame(stock, STOCK_SCHEMA), 8)
        assert {r["line"]: r["status"] for r in decided.collect()} == brute(rows, stock)[0]


def test_sale_larger_than_stock_then_one_that_fits(spark):
    sales = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "a", 9), (1, 3, "a", 4), (2, 4, "a", 1)], SALES_SCHEMA)
    stock = spark.createDataFrame([("a", 10, 1.0, 3.0)], STOCK_SCHEMA)
    rows = ledger.accept_sales(sales, stock).orderBy("line").collect()
    assert [r["status"] for r in rows] == ["ok", "insufficient", "ok", "ok"]
    assert [r["available"] for r in rows] == [10, 5, 5, 1]
    assert rows[0]["gross_profit"] == 15 and rows[0]["net_profit"] == 10
    totals = {r["sale"]: r for r in ledger.sale_totals(ledger.accept_sales(sales, stock)).collect()}
    assert totals[1]["total"] == 27 and totals[1]["insufficient_lines"] == 1 and totals[2]["ok_lines"] == 1


def test_deliveries(spark):
    stock = spark.createDataFrame([("a", 1, 1.0, 2.0), ("b", 2, 1.0, 2.0)], STOCK_SCHEMA)
    new = spark.createDataFrame([(1, "a", 5, 9.0, 9.0), (2, "c", 3, 4.0, 5.0), (3, "c", 2, 8.0, 8.0), (4, "d", 0, 1.0, 1.0)],
                                "line int, product string, quantity long, purchase_price double, selling_price double")
    out = {r["product"]: tuple(r)[1:] for r in ledger.add_products(stock, new).collect()}
    assert out == {"a": (6, 1.0, 2.0), "b": (2, 1.0, 2.0), "c": (5, 4.0, 5.0)}


def brute_events(events, stock):
    """The shop's rules line by line: sold out products leave the list, a delivery of one not listed sets its prices."""
    listed = {p: [q, buy, sell] for p, q, buy, sell in stock if q > 0}
    stopped, out = set(), {}
    for sale, line, product, quantity, delivered, buy, sell in sorted(events, key=lambda r: r[1]):
        bad = quantity is None or quantity <= 0
        if delivered:
            if bad:
                out[line] = ("bad_quantity", None, None)
            elif product in listed:
                listed[product][0] += quantity
                out[line] = ("added", *listed[product][1:])
            else:
                listed[product] = [quantity, buy, sell]
                out[line] = ("listed", buy, sell)
        elif sale in stopped:
            out[line] = ("aborted", None, None)
        elif bad:
            out[line] = ("bad_quantity", None, None)
            stopped.add(sale)
        elif product not in listed:
            out[line] = ("unknown_product", None, None)
        elif quantity > listed[product][0]:
            out[line] = ("insufficient", None, None)
        else:
            out[line] = ("ok", *listed[product][1:])
            listed[product][0] -= quantity
            if not listed[product][0]:
                del listed[product]
    return out, {p: tuple(v) for p, v in listed.items()}


EVENT_SCHEMA = "sale long, line long, product string, quantity long, delivered boolean, purchase_price double, selling_price double"


def random_events(n=1200, seed=3, units=(1, 2, 3, 5, 40, 90, 200, 600)):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        product = "hot" if i % 3 else f"p{rng.randrange(8)}"
        if rng.random() < 0.12:
            rows.append((None, i, product, rng.choice(units) * rng.choice([1, 5]), True, float(i), float(2 * i)))
        else:
            rows.append((i // 4, i, product, rng.choice(units), False, None, None))
    rows[40] = (10, 40, "hot", 0, False, None, None)
    rows[52] = (None, 52, "p1", None, True, 1.0, 2.0)
    rows[60] = (15, 60, None, 2, False, None, None)
    rows[64] = (None, 64, "p6", -4, True, 1.0, 2.0)
    return rows


def outcome(settled):
    priced = ("ok", "added", "listed")
    return {r["line"]: (r["status"], *((r["purchase_price"], r["selling_price"]) if r["status"] in priced else (None, None)))
            for r in settled.collect()}


@pytest.mark.parametrize("slice_rows, pieces, seed", [(10**6, 8192, 3), (50, 8192, 4), (15, 8192, 5), (15, 1, 6), (40, 3, 7)])
def test_deliveries_between_sales(spark, monkeypatch, slice_rows, pieces, seed):
    monkeypatch.setattr(stock_functions, "BLOCK", 7)
    monkeypatch.setattr(ledger, "FEW", 10)
    rows = random_events(700, seed)
    stock = [r for r in STOCK if r[0] != "p4"]
    frames = spark.createDataFrame(rows, EVENT_SCHEMA), spark.createDataFrame(stock, STOCK_SCHEMA)
    settled = ledger.settle(*frames, slice_rows, pieces)
    wanted, left = brute_events(rows, stock)
    assert outcome(settled) == wanted
    closing = ledger.closing_stock(frames[1], settled)
    assert {r["product"]: tuple(r)[1:] for r in closing.collect()} == left


def test_sold_out_and_listed_anew(spark):
    rows = [(1, 1, "a", 2, False, None, None), (None, 2, "a", 5, True, 7.0, 9.0), (2, 3, "a", 6, False, None, None),
            (2, 4, "a", 5, False, None, None), (3, 5, "a", 1, False, None, None), (None, 6, "a", 1, True, 8.0, 8.5),
            (None, 7, "a", 1, True, 1.0, 1.0), (4, 8, "a", 2, False, None, None), (4, 9, "b", 1, False, None, None)]
    stock = [("a", 2, 1.0, 3.0)]
    settled = ledger.settle(spark.createDataFrame(rows, EVENT_SCHEMA), spark.createDataFrame(stock, STOCK_SCHEMA)).orderBy("line").collect()
    assert [r["status"] for r in settled] == [
        "ok", "listed", "insufficient", "ok", "unknown_product", "listed", "added", "ok", "unknown_product"]
    assert [r["gross_profit"] for r in settled if r["status"] == "ok"] == [6.0, 45.0, 17.0]
    assert [r["available"] for r in settled] == [2, 0, 5, 5, 0, 0, 1, 2, None]
    none = ledger.settle(spark.createDataFrame([], EVENT_SCHEMA), spark.createDataFrame([], STOCK_SCHEMA))
    assert none.count() == 0


def test_stock_functions_against_single_stocks(monkeypatch):
    def after(quantity, delivered, stock):
        for q, new in zip(quantity, delivered):
            stock += q if new else -q if q <= stock else 0
        return stock

    for seed in range(200):
        rng = random.Random(seed)
        monkeypatch.setattr(stock_functions, "BLOCK", rng.choice([1, 4, 256]))
        units, share = rng.choice([3, 20, 300]), rng.choice([0, 0.1, 0.4])
        quantity = np.array([rng.randint(1, units) for _ in range(rng.randint(1, 50))])
        delivered = np.array([rng.random() < share for _ in quantity])
        low = rng.randint(0, 40)
        high = low + rng.choice([0, 1, 50, 700])
        function = stock_functions.exact(quantity, delivered, low, high, 10**6)
        bound, (taken, floor) = stock_functions.upper(quantity, delivered, rng.choice([3, 8, 1000])), stock_functions.lower(quantity, delivered)
        most = before = 0
        for stock in range(high + 1):
            rest = after(quantity, delivered, stock)
            most = max(most, rest)
            assert stock < low or function(stock) == rest
            assert bound(stock) >= most and bound(stock) >= before and max(stock - taken, floor) <= rest
            before = bound(stock)
        assert stock_functions.exact(quantity, delivered, low, high, 0) is None


def test_long_stretches_have_few_pieces():
    rng = np.random.default_rng(1)
    for units in (20, 200, 10_000):
        quantity = rng.integers(1, units + 1, 5000)
        none = np.zeros(5000, bool)
        bound = stock_functions.upper(quantity, none, 64)
        assert len(bound) <= 66
        assert len(stock_functions.exact(quantity, none, 0, bound(10 * units), 10**6)) < 100
        assert len(stock_functions.exact(quantity, none, 10**9, 2 * 10**9, 10)) == 1


def arriving(spark, rows, folder, size):
    """One file per batch, read in order of arrival."""
    for k in range(0, len(rows), size):
        part = rows[k:k + size]
        spark.createDataFrame(random.Random(k).sample(part, len(part)), EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_over_several_batches_equals_batch(spark, tmp_path):
    rows, stock = random_events(400, 8), spark.createDataFrame(STOCK, STOCK_SCHEMA)
    stream = arriving(spark, rows[:300], str(tmp_path / "in"), 100)
    runner = SalesStream(stock, str(tmp_path / "state"))
    assert outcome(runner.run(stream)) == brute_events(rows[:300], STOCK)[0]
    assert len(runner.touched) == 3
    assert runner.run(stream).count() == 300  # nothing new has arrived
    rest = [(None, 400 + i, "p2", 3, True, 1.5, 2.5) for i in range(4)]
    stream = arriving(spark, rest, str(tmp_path / "in"), 100)  # the next run goes on from the state of the last
    decided = runner.run(stream)
    wanted, left = brute_events(rows[:300] + rest, STOCK)
    assert outcome(decided) == wanted
    assert runner.touched == [1]  # one product was delivered, one product's state is written
    listed = {r["product"]: (r["quantity"], r["purchase_price"], r["selling_price"]) for r in runner.state().collect() if r["quantity"]}
    assert listed == left


def test_closed_sales_are_forgotten_after_the_limit(spark, tmp_path):
    rows = [(1, 1, "p3", 0, False, None, None), (1, 2, "p3", 1, False, None, None), (2, 3, "p3", 1, False, None, None)]
    later = [(1, 4, "p3", 1, False, None, None)]
    for limit, wanted in ((10**9, "aborted"), (1, "ok")):
        folder, stock = str(tmp_path / f"in-{limit}"), spark.createDataFrame(STOCK, STOCK_SCHEMA)
        runner = SalesStream(stock, str(tmp_path / f"state-{limit}"), limit)
        runner.run(arriving(spark, rows, folder, 5))
        time.sleep(0.1)
        found = runner.run(arriving(spark, later, folder, 5)).collect()
        assert {r["line"]: r["status"] for r in found} == {1: "bad_quantity", 2: "aborted", 3: "ok", 4: wanted}


def test_products_with_few_lines_are_folded_whole(spark, monkeypatch):
    def cut(*_):
        raise AssertionError("no product has so many lines")

    monkeypatch.setattr(ledger, "FEW", 1)
    monkeypatch.setattr(ledger, "_slice_entries", cut)
    rows = random_events(300, 9)
    settled = ledger.settle(spark.createDataFrame(rows, EVENT_SCHEMA), spark.createDataFrame(STOCK, STOCK_SCHEMA), 300)
    assert outcome(settled) == brute_events(rows, STOCK)[0]


class MapState(dict):
    containsKey, getValue, updateValue = dict.__contains__, dict.get, dict.__setitem__

    def exists(self):
        return bool(self)

    def iterator(self):
        return iter(list(self.items()))


@pytest.mark.parametrize("few", [0, 100])
def test_one_call_decides_a_bucket_of_sales_and_products(monkeypatch, few):
    monkeypatch.setattr(sales, "FEW", few)
    gate, keeper = sales.SaleGate(1000), sales.StockKeeper()
    gate.closed, keeper.stock = MapState({("-7",): (0,)}), MapState()
    keeper.handleInitialState((5,), pd.DataFrame(
        [("1", 4, 1.0, 2.0), ("2", 1, 1.0, 2.0)], columns=["product", "quantity", "purchase_price", "selling_price"]), None)
    lines = [("7", 1, "1", 1.0, False), ("8", 2, "1", 3.0, False), ("9", 3, "2", 0.0, False), ("9", 4, "1", 1.0, False),
             (None, 5, "2", 1.0, False), ("8", 6, "1", 2.0, False), ("8", 7, "3", 1.0, False)]
    block = pd.DataFrame(lines, columns=["sale", "line", "product", "quantity", "delivered"]).assign(
        purchase_price=np.nan, selling_price=np.nan, closing=["" if r[0] is None else "-" + r[0] for r in lines])
    marked = pd.concat(gate.handleInputRows((3,), iter([block.iloc[::-1]]), None))
    assert marked["early"].tolist() == ["aborted", None, "bad_quantity", "aborted", None, None, None]
    assert gate.closed == {("-7",): (0,), ("-9",): (3,)}
    decided = pd.concat(keeper.handleInputRows((5,), iter([marked]), None))
    assert decided["status"].tolist() == ["aborted", "ok", "bad_quantity", "aborted", "ok", "insufficient", "unknown_product"]
    assert {k: v[0] for k, v in keeper.stock.items()} == {("1",): 1, ("2",): 0}
