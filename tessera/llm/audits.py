"""Interaction of corpus filters: what each filter removes at each place of each order in which they can be applied.

Documents are first counted into mask cells, one per part and set of failed filters, so that the orders are walked over at
most 32 cells a part and never over documents. The walk is a recursive common table expression: from the empty prefix each
level appends every letter not used yet, meets the part's cells and carries the bits applied so far; the rows of a level
are the metrics of that step. Prefixes are shared by the orders that begin with them, so five filters take 325 rows a
part, of which the 120 orders are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.support import only
from tessera.session import written

#: White space between words.
BLANKS = " \t\n\x0b\f\r"
#: Letter of the filter that fails a text found under a smaller id too; it needs the whole table, the others one text.
COPIES = "E"


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions by letter, for a text that is not null: few words, repetition, capitals, symbols."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.split(bare, f"[{BLANKS}]+")
    n_words = F.when(bare == "", 0).otherwise(F.size(words))
    n_distinct = F.when(bare == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * n_distinct < 50 * n_words,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame, part_column: str = "source", text_column: str = "text",
          id_column: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: rows of ``docs`` by part and set of failed filters (bit 0 is filter A).

    A null text counts as an empty one, a null part as the empty part. A text fails filter E if another row with the same
    text has a smaller id; rows of one id do not fail each other, and a null id is neither smaller nor greater than any.
    A document is good (toxic) if some row of ``labels`` with its id has quality 1 (toxic 1).

    Texts leave their task as digests. Copies are counted per digest and part before they meet, so a text that makes
    up a third of all rows is a few rows by then, and rows without an id are spread over the tasks.
    """
    source = only(docs, id=id_column, part=part_column, text=text_column)
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(failed, 1 << bit).otherwise(0) for bit, failed in enumerate(failures(text).values())), F.lit(0))
    slim = source.select(
        "id", F.coalesce("part", F.lit("")).alias("part"), mask.cast("int").alias("mask"),
        F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"),
        F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(0).alias("salt"))
    marks = only(labels, id=id_column, quality="quality", toxic="toxic").filter("id is not null").groupBy("id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    labelled = slim.join(marks.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left").fillna(0, ["good", "toxic"])

    kind = ["digest", "mask", "part", "good", "toxic"]
    per_id = labelled.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    per_kind = written(per_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(F.when(known, F.struct("id", "n"))).alias("least"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("without_id")), "kinds")
    firsts = per_kind.groupBy("digest").agg(F.min("least.id").alias("first"))
    fresh = F.col("without_id") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    copy_bit = 1 << len(failures(text))
    counted = per_kind.join(firsts, "digest").select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), fresh.alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(copy_bit)).alias("mask"), (F.col("n") - fresh).alias("n")))).alias("cell"))
    n = F.col("cell.n")
    return counted.filter("cell.n > 0").groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


#: ``{steps}`` holds, for every set of applied filters and every letter outside it, the letter's bit and the set after it.
#: ``{cells}`` has one row per part with its array of at most 2^filters cells.
WALK = """
WITH RECURSIVE walk (part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost)
MAX RECURSION LEVEL {depth} AS (
    SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {cells}
    UNION ALL
    SELECT w.part, concat(w.prefix, s.letter), s.after, w.step + 1, s.letter,
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & s.after = 0, x.n, 0L)),
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & s.after = s.bit, x.n, 0L)),
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & s.bit <> 0 AND x.mask & w.applied <> 0, x.n, 0L)),
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask = s.bit, x.n, 0L)),
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & s.after = s.bit, x.good, 0L)),
        aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & s.after = s.bit, x.toxic, 0L))
    FROM walk w JOIN {steps} s ON s.before = w.applied JOIN {cells} c ON c.part = w.part)
SELECT * FROM walk WHERE step > 0 LIMIT ALL
"""

ORDERS = """
WITH RECURSIVE orders (filter_order, applied) MAX RECURSION LEVEL {depth} AS (
    SELECT '', 0
    UNION ALL
    SELECT concat(o.filter_order, s.letter), s.after FROM orders o JOIN {steps} s ON s.before = o.applied)
SELECT filter_order, step, left(filter_order, step) AS prefix
FROM (SELECT filter_order, explode(sequence(1, length(filter_order))) AS step FROM orders WHERE length(filter_order) = {n})
LIMIT ALL
"""


def walked(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part and non-empty prefix of an order: the metrics of the prefix's last step.

    ``counted`` is a table of ``cells``, whose bit i belongs to ``letters[i]``. The columns are ``part, prefix, applied,
    step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost``. A part with no row has no result.
    """
    spark = counted.sparkSession
    arrays = written(counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "cells")
    return spark.sql(WALK, cells=arrays, steps=_steps(spark, letters), depth=len(letters) + 1)


def orders(spark, letters: str = "ABCDE") -> DataFrame:
    """``filter_order, step, prefix``: every order of the letters with its prefixes."""
    return spark.sql(ORDERS, steps=_steps(spark, letters), depth=len(letters) + 1, n=len(letters))


def _steps(spark, letters: str) -> DataFrame:
    rows = [(before, letter, 1 << bit, before | 1 << bit)
            for before in range(1 << len(letters)) for bit, letter in enumerate(letters) if not before >> bit & 1]
    values = ", ".join(f"({a}, '{b}', {c}, {d})" for a, b, c, d in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(before, letter, bit, after)")


def audit(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every order and step of every part, with ``shapley``: what the step's filter removes, summed over all orders.

    A filter's removals at a prefix count once for each order that begins with it, that is (letters left)! times.
    """
    spark = counted.sparkSession
    steps = written(walked(counted, letters), "walk")
    weight = F.factorial(F.lit(len(letters)) - F.col("step"))
    shares = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * weight).alias("shapley"))
    return (
        steps.join(F.broadcast(orders(spark, letters)), ["step", "prefix"])  # as many rows as steps of all orders
        .join(shares, ["part", "letter"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                "shapley"))


def interactions(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five filters over ``docs``; no rows for an empty table."""
    counted = cells(docs, labels, **columns)
    return audit(counted, "".join(failures(F.lit(""))) + COPIES)


#: The same counts without cells, prefixes or recursion.
SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
smallest AS (SELECT text, min(doc_id) AS least FROM words GROUP BY text),
failed AS (
    SELECT d.doc_id, d.part, len(w) < 200 AS "A", 100 * len(list_distinct(w)) < 50 * len(w) AS "B",
        100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 2 * length(d.text) AS "C",
        regexp_matches(d.text, '[#$%&*|]') AS "D", coalesce(s.least < d.doc_id, false) AS "E"
    FROM words d JOIN smallest s ON s.text = d.text),
marked AS (
    SELECT f.*, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
        concat(CASE WHEN "A" THEN 'A' ELSE '' END, CASE WHEN "B" THEN 'B' ELSE '' END, CASE WHEN "C" THEN 'C' ELSE '' END,
            CASE WHEN "D" THEN 'D' ELSE '' END, CASE WHEN "E" THEN 'E' ELSE '' END) AS fails
    FROM failed f LEFT JOIN (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l
    ON l.doc_id = f.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
permuted AS (
    SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
kinds AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM marked GROUP BY part, fails),
places AS (
    SELECT filter_order, CAST(s.step AS INTEGER) AS step, filter_order[s.step] AS letter, filter_order[1:s.step - 1] AS earlier
    FROM permuted, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
met AS (
    SELECT part, filter_order, step, letter, fails, n, good, toxic, contains(fails, letter) AS here,
        translate(fails, earlier, '') <> fails AS before FROM kinds, places),
counted AS (
    SELECT part, filter_order, step, letter,
        CAST(coalesce(sum(n) FILTER (NOT here AND NOT before), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (here AND NOT before), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (here AND before), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (here AND NOT before), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS BIGINT) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
