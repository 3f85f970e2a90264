"""Sales and deliveries as a stream, with the stock of every product in keyed state.

Two operators follow each other. The first remembers the sales that a bad quantity has closed, and forgets them after a
time limit. The second holds stock and listing prices by product; a batch writes the state of the products it touches
and of no others. The rules are those of ``ledger.settle``.

Spark calls an operator once per key of a batch, which costs far more than deciding a few lines, so the keys are buckets of
sales and of products, and the state of a bucket is a map with an entry per closed sale or product.

Lines must arrive in order, batch by batch; within a batch they are sorted here. A task folds the lines that one batch
has of a bucket, so the trigger's size bounds what a hot product brings at once; histories are worked on by ``ledger.settle``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators.stock_functions import fold
from tessera.session import fresh_path

#: Keyed state with variables needs this store; with a time limit, batches without input would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
WEEK = 7 * 24 * 3600 * 1000  # milliseconds
BUCKETS = 1024
NO_PRODUCT = -1  # the bucket of lines without a product
FEW = 32  # entries of a bucket that are asked for one by one, not by reading the bucket
# Sales and products pass as texts: numbers with nulls among them would reach pandas as floating-point numbers.
LINE = "sale string, line long, product string, quantity long, delivered boolean"
PRICES = ", purchase_price double, selling_price double"
MARKED = LINE + PRICES + ", early string"
MARKED_COLUMNS = [field.split()[0] for field in MARKED.split(", ")]
DECIDED = LINE + ", status string, available long" + PRICES


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values("line", ignore_index=True)


def _bucket(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


class SaleGate(StatefulProcessor):
    """Marks bad quantities, and every line behind the first one of its sale. Deliveries pass, in buckets of their own."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.closed = handle.getMapState("closed", "sale string", "line long", self.limit_ms)

    def handleInputRows(self, key, rows, timerValues):
        block = _sorted(rows)
        bad = (block["quantity"].isna() | (block["quantity"] <= 0)).to_numpy(bool)
        early = np.where(bad, "bad_quantity", None)
        sold = ~block["delivered"].to_numpy(bool)
        if sold.any():
            at, (of_sale, sales) = np.arange(len(block)), pd.factorize(block["closing"])
            stops = np.full(len(sales), len(block))
            np.minimum.at(stops, of_sale[bad & sold], at[bad & sold])
            known = self._known(sales.tolist())
            for i in np.flatnonzero((stops < len(block)) & ~known):
                self.closed.updateValue((sales[i],), (int(block["line"].iloc[stops[i]]),))
            early = np.where(sold & (known[of_sale] | (at > stops[of_sale])), "aborted", early)
        yield block[MARKED_COLUMNS[:-1]].assign(early=early)

    def _known(self, sales: list[str]) -> np.ndarray:
        if not self.closed.exists():
            return np.zeros(len(sales), bool)
        if len(sales) <= FEW:
            return np.array([self.closed.containsKey((sale,)) for sale in sales], bool)
        closed = {sale for (sale,) in self.closed.keys()}
        return np.array([sale in closed for sale in sales], bool)

    def close(self) -> None:
        pass


class StockKeeper(StatefulProcessor):
    """Decides the lines of a bucket of products against their stock; state stays at quantity 0 when a product is sold out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stock = handle.getMapState("stock", "product string", "quantity long, purchase_price double, selling_price double")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = initialState.drop_duplicates("product")
        columns = (rows[name].tolist() for name in ("product", "quantity", "purchase_price", "selling_price"))
        for product, quantity, purchase, selling in zip(*columns):
            self.stock.updateValue((product,), (max(int(quantity), 0), _price(purchase), _price(selling)))

    def handleInputRows(self, key, rows, timerValues):
        block = _sorted(rows)
        live = block["early"].isna().to_numpy(bool)
        status, available = block["early"].to_numpy(object).copy(), np.full(len(block), None, object)
        paid = [np.full(len(block), np.nan), np.full(len(block), np.nan)]
        if key[0] == NO_PRODUCT:
            status[live] = "unknown_product"
        elif live.any():
            at = np.flatnonzero(live)
            of_product, products = pd.factorize(block["product"].to_numpy()[live])
            at, of_product = (a[np.argsort(of_product, kind="stable")] for a in (at, of_product))
            quantity = block["quantity"].to_numpy(float)[at].astype(np.int64)
            delivered = block["delivered"].to_numpy(bool)[at]
            own = [block[name].to_numpy(float)[at] for name in ("purchase_price", "selling_price")]
            edges = np.searchsorted(of_product, np.arange(len(products) + 1))
            before = self._known(products.tolist())
            for product, state, start, end in zip(products.tolist(), before, edges[:-1], edges[1:]):
                here, span = at[start:end], slice(start, end)
                status[here], available[here], *prices = self._decided(
                    product, state, quantity[span], delivered[span], [column[span] for column in own])
                for column, price in zip(paid, prices):
                    column[here] = price
        yield pd.DataFrame({
            "sale": block["sale"], "line": block["line"], "product": block["product"], "quantity": block["quantity"],
            "delivered": block["delivered"], "status": status,
            "available": pd.array(available, "Int64"), "purchase_price": paid[0], "selling_price": paid[1]})

    def _known(self, products: list) -> list[tuple | None]:
        if not self.stock.exists():
            return [None] * len(products)
        if len(products) <= FEW:
            return [self.stock.getValue((product,)) for product in products]
        wanted = set(products)
        found = {product: state for (product,), state in self.stock.iterator() if product in wanted}
        return [found.get(product) for product in products]

    def _decided(self, product, state, quantity, delivered, own) -> tuple[np.ndarray, ...]:
        """Status, available stock and both prices of one product's lines, in order."""
        unknown = state is None
        left, *prices = state if not unknown else (0, None, None)
        before, accepted = fold(quantity, delivered, left)
        listing = delivered & (before == 0)
        latest = np.maximum.accumulate(np.where(listing, np.arange(len(before)), -1))
        ever = np.maximum.accumulate(delivered) if unknown else np.ones(len(before), bool)
        status = np.where(delivered, np.where(before == 0, "listed", "added"), np.where(
            before == 0, "unknown_product", np.where(accepted, "ok", "insufficient")))
        paid = [np.where(latest >= 0, mine[latest], np.nan if old is None else old) for mine, old in zip(own, prices)]
        if not unknown or delivered.any():
            change = delivered[-1] * quantity[-1] - (accepted[-1] and not delivered[-1]) * quantity[-1]
            self.stock.updateValue((product,), (int(before[-1] + change), *(_price(column[-1]) for column in paid)))
        return status, np.where(ever, before, None), *paid

    def close(self) -> None:
        pass


def _price(value) -> float | None:
    return None if value is None or pd.isna(value) else float(value)


def settled_stream(events: DataFrame, stock: DataFrame, limit_ms: int = WEEK) -> DataFrame:
    """The stream of ``events`` (see ``ledger.settle``) with status, available, listing prices and profits.

    ``stock`` is the stock before the first batch. A sale closed by a bad quantity is remembered for ``limit_ms``
    milliseconds of processing time. ``available`` is null for a product that was never in stock or delivered before.
    """
    kinds = {name: events.schema[name].dataType.simpleString() for name in ("sale", "product")}
    sale, product = (F.col(name).cast("string") for name in ("sale", "product"))
    closing = F.coalesce(F.concat(F.lit("-"), sale), F.lit(""))
    key = F.when(F.col("delivered"), -1 - _bucket(F.col("line"))).otherwise(_bucket(closing))
    lines = events.select(
        sale.alias("sale"), F.col("line").cast("long").alias("line"), product.alias("product"),
        F.col("quantity").cast("long").alias("quantity"), "delivered", F.col("purchase_price").cast("double").alias("purchase_price"),
        F.col("selling_price").cast("double").alias("selling_price"), closing.alias("closing"), key.alias("_key"))
    marked = lines.groupBy("_key").transformWithStateInPandas(
        SaleGate(limit_ms), MARKED, "append", "processingTime")
    placed = marked.withColumn("_key", F.when(F.col("product").isNull(), NO_PRODUCT).otherwise(_bucket(F.col("product"))))
    named = F.col("product").cast(kinds["product"]).cast("string")  # as in the events
    listed = stock.filter("product is not null").select(
        named.alias("product"), F.col("quantity").cast("long").alias("quantity"),
        F.col("purchase_price").cast("double").alias("purchase_price"), F.col("selling_price").cast("double").alias("selling_price"),
        _bucket(named).alias("_key"))
    decided = placed.groupBy("_key").transformWithStateInPandas(
        StockKeeper(), DECIDED, "append", "processingTime", listed.groupBy("_key"))
    decided = decided.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})
    ok, gross = F.col("status") == "ok", F.col("quantity") * F.col("selling_price")
    return decided.select("*", F.when(ok, gross).alias("gross_profit"),
                          F.when(ok, gross - F.col("quantity") * F.col("purchase_price")).alias("net_profit"))


class SalesStream:
    """One ledger: its decided lines and checkpoint in a folder that all machines reach."""

    def __init__(self, stock: DataFrame, folder: str | None = None, limit_ms: int = WEEK):
        self.spark: SparkSession = stock.sparkSession
        self.folder = folder or fresh_path(self.spark, "ledger")
        self.stock, self.limit_ms = stock, limit_ms
        self.touched: list[int] = []  # products whose state the last run wrote, by batch

    def run(self, events: DataFrame) -> DataFrame:
        """Decide everything that has arrived; a run after a failure, or with more input, goes on where the last one ended."""
        decided = settled_stream(events, self.stock, self.limit_ms)
        before = {name: self.spark.conf.get(name, None) for name in SETTINGS}
        for name, value in SETTINGS.items():
            self.spark.conf.set(name, value)
        try:
            query = decided.writeStream.format("parquet").option("path", f"{self.folder}/decided").option(
                "checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
            self.touched = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators]
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value) if value is not None else self.spark.conf.unset(name)
        return self.spark.read.schema(decided.schema).parquet(f"{self.folder}/decided")

    def state(self, batch: int | None = None) -> DataFrame:
        """Stock and prices of every product seen so far, read from the state after the last or a given batch."""
        reader = self.spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "stock")
        if batch is not None:
            reader = reader.option("batchId", batch)
        return reader.load(f"{self.folder}/checkpoint").select(
            F.col("user_map_key.product").cast(self.stock.schema["product"].dataType).alias("product"), "user_map_value.*")
