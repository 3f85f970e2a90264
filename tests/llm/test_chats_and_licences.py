import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

from frames import TEXTS, documents, empty

from tessera.llm import chats, licences

SCHEMA = "conv_id long, turn long, role string, text string, position int, key string, rendered string, hash string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "x", "h") for r in rows], SCHEMA)


def slow(rows):
    """Maximal conversations as (id, copies, rendered turns), for turns without ties."""
    chat = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        chat[conv].append((role, text))
    whole = defaultdict(list)
    for conv, turns in chat.items():
        whole[tuple(turns)].append(conv)
    out = []
    for turns, convs in whole.items():
        if not any(len(o) > len(turns) and o[:len(turns)] == turns for o in whole):
            known = [c for c in convs if c is not None]
            pieces = [f"<|im_start|>{'user' if r is None else r}\n{t or ''}<|im_end|>\n" for r, t in turns]
            out.append((min(known) if known else None, len(convs), tuple(pieces)))
    return sorted(out, key=str)


def collected(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r.conv_id].append((r.position, r.n_turns, r.copies, r.start, r.rendered))
    out = []
    for conv, turns in found.items():
        turns.sort()
        assert [t[0] for t in turns] == list(range(1, turns[0][1] + 1))
        assert [t[3] for t in turns] == [sum(len(u[4]) for u in turns[:i]) for i in range(len(turns))]
        out.append((conv, turns[0][2], tuple(t[4] for t in turns)))
    return sorted(out, key=str)


def test_snapshots_collapse(spark):
    rng, rows = random.Random(2), []
    for conv in range(120):
        rows += [(conv, turn, rng.choice(["user", "assistant"]), rng.choice("ab")) for turn in range(rng.randint(1, 6))]
    rows += [(500, turn, "user", f"turn {turn}") for turn in range(400)] + [(501, turn, "user", f"turn {turn}") for turn in range(399)]
    assert collected(chats.formatted(frame(spark, rows))) == slow(rows)


def test_awkward_turns(spark):
    rows = [(1, 0, None, "a"), (1, 1, "user", None), (2, 0, "user", "a"), (2, 1, "user", ""), (3, 0, "", "a"), (3, 1, "a", None),
            (None, 0, "user", "a"), (None, 1, "user", "b"), (4, None, "user", "first"), (4, 5, "user", "x" * 100_000), (5, 3, None, "a"),
            (6, 0, "user", "a"), (6, 1, "user", "b")]
    assert collected(chats.formatted(frame(spark, rows))) == slow(rows)
    assert chats.formatted(frame(spark, [])).count() == 0


def test_repeated_turns_keep_a_fixed_order(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    found = collected(chats.formatted(frame(spark, rows)))
    assert len(found) == 1 and found[0][:2] == (1, 2) and len(found[0][2]) == 3


def slow_canonical(text):
    out = "\n" + "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out = re.sub(licences.COPYRIGHT, "\n", out)
    out = re.sub("[^a-z0-9]+", " ", out)
    for a, b in licences.SPELLINGS:
        out = out.replace(a, b)
    return out.strip(" ")


def test_equal_licences_and_others(spark):
    mit = licences.KNOWN[0][1]
    changed = "# Copyright (c) 2020 Someone\n(C) 2021 Another\n\n" + mit.upper().replace(",", " ;").replace(" THE ", "\n  THE ")
    isc = dict(reversed(licences.KNOWN))["ISC"].replace("PROVIDED", "provided -- ")
    rows = [(0, changed), (1, isc.replace("license", "licence")), (2, mit + " x"), (3, None), (4, "Copyright 2020"), (5, ""), (6, mit.replace("above copyright", "above\ncopyright"))]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, digest string, licence string")
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert {i: r.licence for i, r in found.items()} == {0: "MIT", 1: "ISC", 2: None, 3: None, 4: None, 5: None, 6: "MIT"}
    for doc_id, text in rows:
        assert found[doc_id].digest == hashlib.sha256(slow_canonical(text).encode()).hexdigest()


def test_titles_owners_and_full_texts(spark):
    mit, isc, bsd = licences.KNOWN[0][1], dict(reversed(licences.KNOWN))["ISC"], dict(licences.KNOWN)["BSD-3-Clause"]
    full = {p.stem: p.read_text("utf-8") for p in (Path(licences.__file__).parent / "licence_texts").glob("*.txt")}
    cases = [("The MIT License (MIT)\n\nCopyright (c) 2020 A B\n\n" + mit, "MIT"), ("ISC License\n\nCopyright <YEAR> <HOLDER>\n\n" + isc, "ISC"),
             ("BSD 3-Clause License\n\nCopyright The Foo Authors\nAll rights reserved.\n\n" + bsd, "BSD-3-Clause"),
             ("# Copyright Jane Doe\n# (c) Foo, Inc.\n# © Foo\n" + mit, "MIT"), ("COPYRIGHT THE FOO AUTHORS\n" + mit.upper(), "MIT"),
             ("(c) no commercial use\n" + mit, None), ("(c)\n(c) 2020 Foo. No commercial use.\n" + mit, None),
             ("ISC License\n\n" + mit, None), ("All rights reserved, no use without a contract\n" + mit, None), ("MIT License", None),
             (bsd.replace("HOLDERS AND CONTRIBUTORS", "\nHOLDERS AND CONTRIBUTORS"), "BSD-3-Clause"),
             (bsd.replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "\nCOPYRIGHT HOLDERS AND CONTRIBUTORS\n"), "BSD-3-Clause"),
             (full["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Foo"), "Apache-2.0"),
             (full["Apache-2.0"][:full["Apache-2.0"].index("APPENDIX")], "Apache-2.0"), (full["GPL-2.0"] + "\nand more", None)]
    cases += [("\n  " + text.replace("\n", "\r\n ").upper(), name) for name, text in full.items()]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(full)
    docs = documents(spark, [(i, text, "en", "s") for i, (text, _) in enumerate(cases)])
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert [(found[i].licence, text[:60]) for i, (text, _) in enumerate(cases)] == [(name, text[:60]) for text, name in cases]
    for i, (text, _) in enumerate(cases):
        assert found[i].digest == hashlib.sha256(slow_canonical(text).encode()).hexdigest()


def test_awkward_documents(spark):
    rows = licences.scan(documents(spark)).collect()
    wanted = sorted(((d, hashlib.sha256(slow_canonical(t).encode()).hexdigest(), None) for d, t, *_ in TEXTS), key=str)
    assert sorted(map(tuple, rows), key=str) == wanted
    assert licences.scan(empty(spark)).count() == 0
    own = spark.createDataFrame([("none", "!!"), ("own", TEXTS[0][1]), ("other", TEXTS[8][1])], "licence string, text string")
    assert {r.licence for r in licences.scan(documents(spark), own).collect()} == {None, "other", "own"}
