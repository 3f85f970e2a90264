"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most ``d`` of 64 bits agree in one of ``d + 1`` chunks. Each
distinct fingerprint is therefore dealt out once per chunk, rotated so that the chunk is on
top; the chunk is the prefix of its Gray rank, and groups of equal prefix are independent.
A group above ``limit`` is dealt out again by a chunk of its remaining bits, until
no group is large, so no bucket is capped and no pair is lost. Inside a task the
fingerprints are sorted by Gray rank, which puts codes with many equal bits next to each other;
the bits that all codes below a node share are kept once in that node, and a search
drops the node, with everything below it, when the shared bits already differ too often.

Only what connects a group is given out: one edge per fingerprint at most, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.components import smallest_member
from tessera.llm.support import map_arrow, only, unite, utf8
from tessera.session import written

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SEED = 42
BITS = 64
FAN = 8  # children of an index node


def fingerprint(text: bytes | None, shingle: int, piece: int = 1 << 16) -> int:
    """The SimHash of a text as a signed 64-bit integer; zero without words."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    elif shingle == 3:
        shingles = [a + b" " + b + b" " + c for a, b, c in zip(words, words[1:], words[2:])]
    else:
        shingles = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for start in range(0, len(shingles), piece):
        hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles[start:start + piece]]), np.uint8)
        ones += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, code`` per row: a hash of the text that tells rows of one id apart, and its fingerprint."""
    source = only(docs, doc_id=id_column, text=text_column).withColumn("digest", F.xxhash64("text"))

    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch["doc_id"], "digest": batch["digest"],
                "code": [fingerprint(t, shingle) for t in utf8(batch["text"])]}

    return map_arrow(source, work, "doc_id long, digest long, code long")


# ---------------------------------------------------------------- index inside a task


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The position of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray, groups: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the leaves up: pattern, mask of the shared bits, first and last group, last leaf of every node."""
    full = np.full(len(codes), ~np.uint64(0))
    level = (codes, codes, full, groups, groups, np.arange(len(codes)))
    levels = [level]
    while len(level[0]) > 1:
        every, some, mask, first, last, leaf = level
        at = np.arange(0, len(every), FAN)
        end = np.minimum(at + FAN, len(every)) - 1
        every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
        level = (every, some, ~(every ^ some), first[at], last[end], leaf[end])
        levels.append(level)
    return levels


def linked_roots(codes: np.ndarray, groups: np.ndarray, distance: int, queries: int = 2048) -> np.ndarray:
    """For codes sorted by (group, Gray rank): the position of the smallest linked member of the same group."""
    levels, parent = _levels(codes, groups), np.arange(len(codes))
    for start in range(0, len(codes), queries):
        query = np.arange(start, min(start + queries, len(codes)))
        node = np.zeros(len(query), np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            pattern, _, mask, first, last, leaf = levels[depth]
            keep = (leaf[node] > query) & (first[node] <= groups[query]) & (last[node] >= groups[query])
            query, node = query[keep], node[keep]
            differ = np.bitwise_count((codes[query] ^ pattern[node]) & mask[node])
            query, node = query[differ <= distance], node[differ <= distance]
            if depth:
                below = len(levels[depth - 1][0])
                query = np.repeat(query, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                query, node = query[node < below], node[node < below]
        parent = unite(parent, query, node)
    return parent


def _search(distance: int, block: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(paths: np.ndarray, codes: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        groups = np.concatenate([[0], np.cumsum(paths[1:] != paths[:-1])])
        order = np.lexsort((gray_rank(codes), groups))
        parent = linked_roots(codes[order], groups[order], distance)
        moved = parent != np.arange(len(parent))
        return pa.RecordBatch.from_arrays([nodes[order][moved], nodes[order][parent[moved]]], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by path; blocks of whole groups are indexed together."""
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch["path"].to_numpy(zero_copy_only=False),
                         batch["code"].to_numpy().view(np.uint64), batch["node"].to_numpy()))
            if sum(len(h[0]) for h in held) < block:
                continue
            paths, codes, nodes = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(paths, paths[-1]))  # the last group may go on
            if cut:
                yield found(paths[:cut], codes[:cut], nodes[:cut])
            held = [(paths[cut:], codes[cut:], nodes[cut:])]
        if held:
            yield found(*(np.concatenate(x) for x in zip(*held)))

    return work


# ---------------------------------------------------------------- dealing out


def _bits(code: Column, start: int, count: int) -> Column:
    """``count`` bits of a 64-bit code from bit ``start``, the top bit being 0."""
    return F.shiftrightunsigned(F.shiftleft(code, start), BITS - count) if count < BITS else code


def _dealt(rows: DataFrame, fixed: int, chunks: int) -> DataFrame:
    """One row per chunk of the bits after the first ``fixed``, with that chunk moved up behind them."""
    left = BITS - fixed
    cuts = [left * i // chunks for i in range(chunks + 1)]
    width = min(b - a for a, b in zip(cuts, cuts[1:]))
    rest = F.shiftleft("code", fixed) if fixed else F.col("code")
    out = []
    for start in cuts[:-1]:
        turned = rest if not start else F.shiftleft(rest, start).bitwiseOR(
            F.shiftleft(F.shiftrightunsigned(rest, BITS - start), BITS - left))
        head = _bits(F.col("code"), 0, fixed) if fixed else F.lit(0).cast("long")
        code = turned if not fixed else F.shiftleft(head, left).bitwiseOR(F.shiftrightunsigned(turned, fixed))
        name = F.concat_ws("/", F.col("path"), F.lit(str(start)), F.hex(_bits(turned, 0, width)))
        out.append(F.struct(name.alias("path"), code.alias("code")))
    return rows.select("node", F.explode(F.array(*out)).alias("x")).select("x.path", "x.code", "node"), fixed + width


def links(nodes: DataFrame, distance: int = 3, limit: int = 1024, block: int = 1 << 16) -> DataFrame:
    """Edges ``a, b`` that connect all codes of ``nodes`` (``node``: distinct 64-bit codes) within ``distance`` bits.

    Two codes are connected by a path of edges if and only if they are by links of at most ``distance`` bits.
    """
    chunks = distance + 1
    rows, fixed = _dealt(nodes.select("node", F.col("node").alias("code"), F.lit("").alias("path")), 0, chunks)
    ready = None
    while BITS - fixed > chunks and 1 << min(BITS - fixed, 62) > limit:
        large = written(rows.groupBy("path").count().filter(F.col("count") > limit).select("path"), "large")
        if large.isEmpty():
            break
        small = rows.join(large, "path", "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        rows, fixed = _dealt(rows.join(large, "path", "left_semi"), fixed, chunks)
        rows = written(rows, "dealt")
    rows = rows if ready is None else ready.unionByName(rows)
    return (rows.repartition("path").sortWithinPartitions("path")
            .mapInArrow(_search(distance, block), "a long, b long").distinct())


def groups(docs: DataFrame, shingle: int = 3, distance: int = 3, limit: int = 1024,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, code, component, component_id`` for every row.

    ``component`` tells groups of linked texts apart (it is never null); ``component_id`` is the smallest
    id in the group. Rows without an id belong to groups but never name one, unless no row
    of the group has an id: then ``component_id`` is null. A null text counts as an empty one.
    Rows of the same id are separate rows. An empty table gives an empty result.
    """
    marked = written(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    nodes = marked.groupBy(F.col("code").alias("node")).agg(F.min("doc_id").alias("first"))
    found = smallest_member(nodes, links(nodes, distance, limit))
    return marked.join(found, F.col("code") == F.col("node")).select(
        "doc_id", "digest", "code", "component", F.col("first").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, limit: int = 1024,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: see ``groups``; the fingerprint is 16 lower-case hex digits."""
    return groups(docs, shingle, distance, limit, id_column, text_column).select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3,
                            id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group, all its columns: the one with the smallest id, rows without an id last."""
    found = groups(docs, shingle, distance, 1024, id_column, text_column)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest"))
    kept = found.groupBy("component").agg(first.alias("x")).select(
        F.col("x.doc_id").alias("_kept_id"), F.col("x.digest").alias("_kept_digest"))
    keys = {"_row_id": lambda i, d: F.coalesce(i, F.lit(0)), "_row_without": lambda i, d: i.isNull(), "_row_digest": lambda i, d: d}
    kept = kept.select(*[f(F.col("_kept_id"), F.col("_kept_digest")).alias(k) for k, f in keys.items()])
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"), *[
        f(docs[id_column], F.xxhash64(docs[text_column])).alias(k) for k, f in keys.items()])
    return keyed.join(kept, list(keys), "left_semi").dropDuplicates(list(keys)).select("_all.*")
