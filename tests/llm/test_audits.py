import re
from collections import defaultdict
from itertools import permutations

import pytest
from frames import TEXTS, documents, empty

from tessera.llm import audits

LABELS = "doc_id long, quality int, toxic int, part string, mask int"
SYMBOLS = "pure words " * 150 + "# end"
SHOUT = " ".join(f"WORD{i} x{i}" for i in range(150))
MORE = [(20, SYMBOLS, "en", "a"), (21, SYMBOLS, "en", "b"), (21, SYMBOLS, "en", "b"), (19, SYMBOLS, "en", ""), (None, SYMBOLS, "en", "b"),
        (22, SHOUT, "en", None), (23, SHOUT, "en", "a"), (-5, SHOUT, "en", "it's"), (24, "plain\x85words\xa0stay one", "en", "a"),
        (25, " ".join(f"w{i}" for i in range(200)), "en", "a"), (26, "\x1c" + " y" * 199 + " z", "en", "a")]


def failed(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, text, _, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and first[text] < doc_id:
            fails.add("E")
        yield doc_id, part or "", fails


def brute(rows, labels):
    """Documents are passed through every order one by one."""
    good = {d for d, q, _, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    docs = list(failed(rows))
    out, shapley = {}, defaultdict(int)
    for part in {p for _, p, _ in docs}:
        for order in permutations("ABCDE"):
            alive = [(d, f) for d, p, f in docs if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [x for x in alive if letter in x[1]]
                out[part, "".join(order), step] = [
                    len(alive) - len(removed), len(removed), sum(letter in f for _, f in gone),
                    sum(f == {letter} for _, p, f in docs if p == part), sum(d in good for d, _ in removed),
                    sum(d in toxic for d, _ in removed)]
                shapley[part, letter] += len(removed)
                alive, gone = [x for x in alive if letter not in x[1]], gone + removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("rows", [TEXTS + MORE, MORE[1:4], [(None, None, None, None)]])
def test_every_order_against_single_documents(spark, rows):
    labels = [(0, 1, 0, "p", 1), (0, 0, 1, "p", 1), (2, 1, None, None, 2), (21, None, 1, "q", 3), (None, 1, 1, "q", 3), (22, 1, 1, "q", 4),
              (23, 1, 0, "", 5), (99, 1, 1, "", 5)]
    marks = spark.createDataFrame(labels, LABELS)
    found = audits.interactions(documents(spark, rows), marks).collect()
    assert len(found) == len({p or "" for *_, p in rows}) * 600
    assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in found} == brute(rows, labels)


def test_no_rows(spark):
    docs, marks = empty(spark), spark.createDataFrame([], LABELS)
    assert audits.interactions(docs, marks).count() == 0
    assert audits.interactions(documents(spark), marks).agg({"good_lost": "sum"}).first()[0] == 0


def test_prefixes_are_walked_once(spark):
    counted = spark.createDataFrame([("a", 3, 7, 2, 1), ("a", 0, 5, 5, 0)], "part string, mask int, n long, good long, toxic long")
    rows = audits.walked(counted, "XYZ").collect()
    assert sorted(r.prefix for r in rows) == sorted("".join(p[:n]) for n in (1, 2, 3) for p in {q[:n] for q in permutations("XYZ")})
    assert {(r.kept, r.removed, r.redundant) for r in rows if r.prefix == "XY"} == {(5, 0, 7)}
    assert audits.audit(counted, "XYZ").filter("step = 1 and filter_order like 'Y%'").first().shapley == 3 * 7
