"""Chats: snapshots that longer logs continue are dropped, the rest is rendered turn by turn.

A conversation that was logged again and again while it grew leaves every snapshot as a conversation of its own. Each turn
gets a hash of all turns up to it: four running sums of position-keyed 31-bit hashes, so sums of up to 2**32 turns
are exact and a conversation of any length is summed over many tasks. A conversation is a snapshot if the hash
of its end is the hash of an inner turn of some conversation; anti-joins on these hashes keep the others. Of
conversations with the same turns the one with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.support import only
from tessera.operators.ordered import running
from tessera.session import written

SUMS = ("s0", "s1", "s2", "s3")
PREFIX = ["position", *SUMS]
MASK = (1 << 31) - 1


def template(role: Column, text: Column) -> Column:
    """One rendered turn; a null role is rendered as ``user``, a null text as an empty one."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")),
                    F.lit("<|im_end|>\n"))


def _ranked(turns: DataFrame) -> DataFrame:
    """Turns with ``key`` (never null), ``position`` and ``rendered``, written once."""
    source = only(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    known = F.xxhash64(F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    marked = source.withColumns({"key": key, "hash": known})
    ranked = running(marked, ["turn", "hash"], ["key"], rank="position")
    return written(ranked.select("key", "conv_id", "position", "role", "text", template(F.col("role"), F.col("text")).alias("rendered")), "turns")


def prefix_hashes(ranked: DataFrame) -> DataFrame:
    """``key, conv_id, position, start`` and the four sums: everything up to and with each turn."""
    parts = {}
    for i, seed in enumerate((1, 2)):
        whole = F.xxhash64(F.lit(seed), "position", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
        parts[f"h{2 * i}"] = whole.bitwiseAND(F.lit(MASK))
        parts[f"h{2 * i + 1}"] = F.shiftrightunsigned(whole, 32).bitwiseAND(F.lit(MASK))
    parts["length"] = F.char_length("rendered").cast("long")
    narrow = ranked.select("key", "conv_id", "position", *[c.cast("long").alias(n) for n, c in parts.items()])
    summed = running(narrow, ["position"], ["key"], {**{s: f"h{i}" for i, s in enumerate(SUMS)}, "stop": "length"})
    return written(summed.select("key", "conv_id", *PREFIX, (F.col("stop") - F.col("length")).alias("start")), "prefixes")


def maximal(prefixes: DataFrame) -> DataFrame:
    """``key, n_turns, copies`` of the conversations that no other one continues, one of each set of equal ones."""
    last = F.max(F.struct(*PREFIX)).alias("last")
    ends = written(prefixes.groupBy("key", "conv_id").agg(last).select("key", "conv_id", "last.*"), "ends")
    inner = prefixes.join(ends.select("key", "position"), ["key", "position"], "left_anti").select(*PREFIX).distinct()
    first = F.min(F.struct(F.col("conv_id").isNull().alias("missing"), "conv_id", "key")).alias("first")
    whole = ends.groupBy(*PREFIX).agg(first, F.count(F.lit(1)).alias("copies"))
    return whole.join(inner, PREFIX, "left_anti").select("first.key", F.col("position").alias("n_turns"), "copies")


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, position, n_turns, copies, start, rendered``: the turns of all maximal conversations.

    The pieces of a conversation, joined in order of ``position``, are its training text, in which a piece begins at
    character ``start``; they are not joined here, so a conversation of any length is no single row. Turns are
    in order of ``turn`` (nulls first), equal ones in order of a hash. Rows without ``conv_id`` are one conversation.
    """
    ranked = _ranked(turns)
    prefixes = prefix_hashes(ranked)
    kept = prefixes.join(maximal(prefixes), "key").select("key", "position", "n_turns", "copies", "start")
    return ranked.select("key", "position", "conv_id", "rendered").join(kept, ["key", "position"]).select(
        "conv_id", "position", "n_turns", "copies", "start", "rendered")


SQL = """
WITH ranked AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position
    FROM conversations),
prefixes AS (
    SELECT conv_id, position,
           string_agg(role || chr(30) || text, chr(31)) OVER (PARTITION BY conv_id ORDER BY position) AS so_far,
           '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
    FROM ranked),
ends AS (
    SELECT p.conv_id, p.position AS n_turns, p.so_far
    FROM prefixes p JOIN (SELECT conv_id, max(position) AS n FROM ranked GROUP BY conv_id) e
      ON p.conv_id = e.conv_id AND p.position = e.n),
inner_turns AS (
    SELECT DISTINCT p.so_far FROM prefixes p JOIN ends e ON p.conv_id = e.conv_id WHERE p.position < e.n_turns),
kept AS (
    SELECT min(conv_id) AS conv_id, n_turns, count(*) AS copies FROM ends
    WHERE so_far NOT IN (SELECT so_far FROM inner_turns) GROUP BY so_far, n_turns)
SELECT p.conv_id, p.position, k.n_turns, k.copies,
       CAST(sum(length(p.rendered)) OVER (PARTITION BY p.conv_id ORDER BY p.position) - length(p.rendered) AS BIGINT) AS start,
       p.rendered
FROM prefixes p JOIN kept k ON p.conv_id = k.conv_id
"""
