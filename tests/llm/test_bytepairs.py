import hashlib
import random

import numpy as np
import pytest
from frames import TEXTS, documents, empty
from tokenizers import Tokenizer

from tessera.llm import bytepairs
from tessera.llm.queries import vocabulary_file


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_file())


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("make", [bytepairs.encoder, bytepairs.library_encoder])
def test_same_ids_as_the_library(library, make):
    encoder, rng = make(vocabulary_file()), random.Random(3)
    signs = "ab the ing'sd'll  \n\n\t\r.,!é漢字1239 \xa0 \x1c\x85🙂"
    texts = [t or "" for _, t, *_ in TEXTS]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    texts += ["ab" * 3000, "x" * 3000, " " * 500, "\n" * 500, "é" * 999, "a<|endoftext|>b <|endoftext|>  c", "<|endoftext|"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(encoder.encode(text)) == ids
        assert encoder.decode(encoder.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_pattern_cuts_every_character_as_the_library_does():
    from tokenizers import pre_tokenizers

    cut, encoder = pre_tokenizers.ByteLevel(add_prefix_space=False), bytepairs.encoder(vocabulary_file())
    for code in range(1, 0x110000, 7):
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}1{chr(code)}!  b"
            assert encoder.pattern.findall(text) == [text[a:b] for _, (a, b) in cut.pre_tokenize_str(text)]


def test_broken_bytes_decode_as_the_library_does(library):
    encoder, rng = bytepairs.encoder(vocabulary_file()), random.Random(5)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def merged(word, ranks):
    """Merges in order of rank, leftmost first."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get((parts[i], parts[i + 1]), 1 << 30), i))
        if (parts[best], parts[best + 1]) not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


def test_automaton_of_random_merges():
    """Small alphabets make overlapping and repeated merges common."""
    for seed in range(40):
        rng = random.Random(seed)
        labels, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randint(0, 25)):
            pair = rng.choice(labels), rng.choice(labels)
            if pair[0] + pair[1] not in labels:
                labels.append(pair[0] + pair[1])
                merges.append(pair)
        tokens = {label: i for i, label in enumerate(labels)}
        automaton, ranks = bytepairs.Automaton(tokens, merges), {m: i for i, m in enumerate(merges)}
        for _ in range(300):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert automaton.encode(word) == [tokens[p] for p in merged(word, ranks)]


def test_forgetting_changes_nothing(monkeypatch, library):
    for name in ("WORDS", "PIECES", "STEPS"):
        monkeypatch.setattr(bytepairs, name, 3)
    encoder = bytepairs.Encoder(vocabulary_file())
    for _, text, *_ in TEXTS[:3]:
        assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert max(map(len, (encoder.after_blank, encoder.bare, encoder.pieces, encoder.after_blank.old))) <= 3


def test_what_is_in_use_stays_in_memory():
    class Counted(bytepairs._Remembered):
        calls = 0

        def made(self, key):
            self.calls += 1
            return key.encode()

    memory = Counted(10)
    for i in range(500):
        assert memory["hot"] == b"hot" and memory[f"w{i}"] == f"w{i}".encode() and memory["x" * 65] == b"x" * 65
        assert len(memory) <= 10 and len(memory.old) <= 10
    assert memory.calls == 1 + 500 + 500


def test_awkward_rows(spark, library):
    rows = bytepairs.digests(documents(spark), vocabulary_file()).collect()
    wanted = []
    for doc_id, text, *_ in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)
    assert bytepairs.digests(empty(spark), vocabulary_file()).count() == 0


def test_words_that_need_no_pattern_are_cut_as_by_it(library):
    encoder, rng = bytepairs.library_encoder(vocabulary_file()), random.Random(6)
    calls = []

    class Counted:
        findall = staticmethod(lambda chunk, real=encoder.pattern: calls.append(chunk) or real.findall(chunk))

    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    assert all(encoder.pattern.findall(c) == [c] for c in letters)
    texts = ["".join(rng.choices(letters, k=9)) + rng.choice(["", ",", ".", "'s", "&&&", "ª1", "§"]) for _ in range(2000)]
    texts += ["".join(rng.choices([chr(c) for c in range(128)], k=9)) for _ in range(2000)]
    wanted = [library.encode(f"x {t}", add_special_tokens=False).ids for t in texts]
    encoder.pattern, kept = Counted, encoder.pattern
    try:
        assert [ids_of(encoder.encode(f"x {t}")) for t in texts] == wanted
        before = len(calls)
        assert encoder.encode("x größenwahnzzq, thndntq%%%") and len(calls) == before
    finally:
        encoder.pattern = kept
