"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, checked by exact cosine.

Equal vectors of a label are one node. A node gets one hash per table: the signs of its products with
random hyperplanes. Nodes that share a hash in a table are compared, a bucket above ``block`` nodes in
pairs of blocks, each pair of blocks in a group of its own. A pair counts only in the first table in which it
meets, so links per vector are sums over groups and no pair leaves its task: a group gives the links of each
of its nodes and one edge per node that connects what is linked inside.

A pair at angle ``a`` shares a hash of ``b`` bits with probability ``(1 - a / pi) ** b``. With 16 bits and 32 tables
a pair at cosine 0.98 is missed with probability 1e-6 and nearer ones less. About ``log2`` of the vectors
of a label is the number of bits that keeps buckets of unrelated vectors small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.components import smallest_member
from tessera.llm.support import only, unite
from tessera.session import written

BIT, TABLES, BLOCK = 16, 32, 1024


def usable(vector: Column, label: Column) -> Column:
    """Labels and vectors that can be compared: no null, no NaN or infinite component, not empty, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def sign_hashes(rows: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One integer per row and table."""
    planes = np.random.default_rng([seed, rows.shape[1]]).standard_normal((rows.shape[1], bits * tables))
    signs = (unit(rows) @ planes > 0).reshape(len(rows), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _hashed(nodes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``node, label, n, size, vector`` (bytes of doubles) and ``hashes``."""
    kind = nodes.schema["label"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["embedding"]
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            vectors, hashes = [None] * len(sizes), np.zeros((len(sizes), tables), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = flat[starts[at][:, None] + np.arange(size)]
                hashes[at] = sign_hashes(rows, bits, tables, seed)
                for i, row in zip(at.tolist(), unit(rows)):
                    vectors[i] = row.tobytes()
            offsets = np.arange(0, hashes.size + 1, tables, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["label"], batch["n"], pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(hashes.ravel(), pa.int64()))],
                names=["node", "label", "n", "size", "vector", "hashes"])

    return nodes.mapInArrow(work, f"node long, label {kind}, n long, size int, vector binary, hashes array<long>")


def _compare(rows: np.ndarray, hashes: np.ndarray, table: int, weight: np.ndarray, left: np.ndarray, right: np.ndarray,
             least: float, links: np.ndarray, parent: np.ndarray, tile: int = 512) -> np.ndarray:
    """Count the links between rows ``left`` and ``right`` (the same array: pairs inside it)."""
    inside = left is right
    for a in range(0, len(left), tile):
        for b in range(a if inside else 0, len(right), tile):
            i, j = left[a:a + tile], right[b:b + tile]
            close = rows[i] @ rows[j].T >= least
            if inside and a == b:
                close = np.triu(close, 1)
            at_i, at_j = np.nonzero(close)
            at_i, at_j = i[at_i], j[at_j]
            if table and len(at_i):
                new = ~(hashes[at_i, :table] == hashes[at_j, :table]).any(axis=1)
                at_i, at_j = at_i[new], at_j[new]
            if len(at_i):
                np.add.at(links, at_i, weight[at_j])
                np.add.at(links, at_j, weight[at_i])
                parent = unite(parent, at_i, at_j)
    return parent


def _checked(least: float, tables: int):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def group(rows: pa.Table) -> tuple[np.ndarray, ...]:
        table, low, high = (rows[c][0].as_py() for c in ("table", "low", "high"))
        vectors = np.frombuffer(b"".join(rows["vector"].to_pylist())).reshape(rows.num_rows, -1)
        hashes = rows["hashes"].combine_chunks().flatten().to_numpy().reshape(-1, tables)
        node, weight, block = (rows[c].to_numpy() for c in ("node", "n", "block"))
        links, parent = np.zeros(len(node), np.int64), np.arange(len(node))
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        parent = _compare(vectors, hashes, table, weight, left, right, least, links, parent)
        found = links > 0
        return node[found], links[found], node[parent[found]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group may go on in the next batch."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            keys = [rows[c].to_numpy() for c in ("bucket", "low", "high")]
            starts = np.concatenate([[0], np.flatnonzero(sum(k[1:] != k[:-1] for k in keys)) + 1])
            found = [group(rows.slice(a, b - a)) for a, b in zip(starts, starts[1:])]
            rest = rows.slice(starts[-1])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)
        if rest is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in group(rest)], schema=schema)

    return work


def linked(nodes: DataFrame, least: float, bits: int = BIT, tables: int = TABLES, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """``node, links, root`` per node and group with a link: links found there, and a linked node of the group."""
    hashed = written(_hashed(nodes, bits, tables, seed), "hashed")
    keyed = hashed.select("node", "label", "size", F.posexplode("hashes").alias("table", "hash"))
    key = ["label", "size", "table", "hash"]
    shared = keyed.groupBy(*key).count().filter("count > 1").withColumn("bucket", F.monotonically_increasing_id())
    shared = written(shared, "buckets")
    blocks = F.ceil(F.col("count") / block).cast("int")
    placed = keyed.join(shared, key).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.select("node", "table", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("node", "table", "bucket", "block", F.least("block", "other").alias("low"),
                           F.greatest("block", "other").alias("high"))
    full = placed.join(hashed.select("node", "n", "vector", "hashes"), "node")
    return (full.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
            .mapInArrow(_checked(least, tables), "node long, links long, root long"))


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label", **options) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row.

    Rows link if their labels are equal and their vectors, of equal length, have a cosine of ``least`` or more.
    Null labels and vectors that cannot be compared (see ``usable``) link with nothing. Equal vectors,
    also repeated rows, are linked rows. Rows without an id count in ``n_links`` and connect others, but name a
    component only (as null) if none of its rows has an id. An empty table gives an empty result.
    """
    source = only(vectors, vec_id=id_column, embedding=vector_column, label=label_column)
    source = source.withColumn("usable", usable(F.col("embedding"), F.col("label")))
    nodes = source.filter("usable").groupBy("label", "embedding").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = written(linked(nodes, least, **options), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    connected = smallest_member(nodes.select("node", "first"), found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("label", "embedding", "n", "node").join(links, "node", "left").join(
        connected.select("node", F.col("first").alias("component_id")), "node")
    known = known.select(
        "label", "embedding", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    compared = source.filter("usable").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = source.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return compared.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
