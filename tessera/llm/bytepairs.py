"""Byte-pair encoding with a tokenization automaton.

The merges are compiled, in order, into a deterministic automaton over tokens that accepts exactly
the correct token sequences. It starts as one state with a loop for every byte. The gadget of a
merge ``u v -> w`` gives ``u`` a target state of its own (a copy of the old one, if other
arcs lead there too), takes the arc ``v`` out of it, and adds an arc ``w``, with the target that ``v``
had, to every state that has an arc ``u``. Copies and added arcs are kept as rules, not as rows
of a table: a state knows the state it was copied from and when, and which arcs it lost and when, so
50,000 merges need some 50,000 small entries, and an arc is looked up along these rules once.

A word is encoded from left to right: from a state, the arc with the longest label that the word goes on
with is taken (transitions of a byte trie), then the next shorter one, and so on. Every prefix of a word has
exactly one correct sequence, so a position with no arc onwards is not on the path, whatever led to
it, and is entered once.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.support import map_arrow, only

#: Fixed: white space, and the pattern that splits text before merging.
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: Fixed: code points that the tokenizer's Unicode tables do not hold as letters or numbers, though newer ones may.
UNLISTED = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
LETTER, NUMBER = (rf"[\p{{{name}}}--[{UNLISTED}]]" for name in "LN")
PATTERN = (rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{LETTER}+| ?{NUMBER}+| ?[^[{SPACE}]||{LETTER}||{NUMBER}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same pattern where all characters are ASCII, for the faster engine.
ASCII_SPACE = r"\t\n\x0b\x0c\r "
ASCII_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^{ASCII_SPACE}A-Za-z0-9]+"
                 rf"|[{ASCII_SPACE}]+(?![^{ASCII_SPACE}])|[{ASCII_SPACE}]+")
WORDS, PIECES, STEPS = 120_000, 20_000, 300_000  # entries that a worker remembers; words and pieces in each of two generations
LIBRARY_WORDS = 400_000  # the same for words where no automaton takes room
MARKS = frozenset(".,;:!?")
LATIN_END = "\u0250"  # below, a character is a letter to Python just where it is one to the pattern


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Automaton:
    """The token automaton of a list of merges; states, arcs and the trie of arc labels."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = max(tokens.values(), default=-1) + 1
        self.size, self.made, self.left = size, [0] * size, [-1] * size
        self.dead = [False] * size
        self.target: list[int] = [0] * size  # state behind the arcs of a token
        self.parent, self.copied = [0], [0]  # of each state
        self.lost: dict[int, int] = {}  # (state, token) -> when the arc was taken out
        users = [1]  # arcs' tokens that lead to a state; the start counts as one
        for byte in range(256):
            users[0] += bytes([byte]) in tokens
        for when, (u, v) in enumerate(merges, 1):
            first, second, whole = tokens[u], tokens[v], tokens[u + v]
            self.made[whole], self.left[whole] = when, first
            state = self.target[first]
            if self.dead[first] or not self._has(state, second, when - 1):
                self.dead[whole] = True  # the pair never comes up
                continue
            self.target[whole] = self.target[second]
            users[self.target[whole]] += 1
            if users[state] > 1:
                users[state] -= 1
                users.append(1)
                self.parent.append(state)
                self.copied.append(when)
                self.target[first] = state = len(users) - 1
            self.lost[state * size + second] = when
        self.last = len(merges)
        self.steps: dict[int, int] = {}  # (state, token) -> the token itself or the next shorter one with an arc
        self.words = {label: token for label, token in tokens.items() if not self.dead[token]}
        self.shorter, self.length = [-1] * size, [0] * size  # the next shorter label that begins a label
        self.best: dict[bytes, int] = {}  # what a label begins with, of any length, to the longest label within it
        for label, token in sorted(self.words.items(), key=lambda item: len(item[0])):
            found, self.length[token] = -1, len(label)
            for stop in range(1, len(label)):
                found = self.best.setdefault(label[:stop], found)
            self.shorter[token], self.best[label] = found, token
        self.reach = max(map(len, self.words), default=0)

    def _has(self, state: int, token: int, when: int) -> bool:
        """Whether the state had an arc of the token after the gadget number ``when``."""
        while True:
            gone = self.lost.get(state * self.size + token)
            if self.dead[token] or gone is not None and gone <= when:
                return False
            if self.made[token] < self.copied[state]:
                when, state = self.copied[state] - 1, self.parent[state]
            elif self.left[token] < 0:
                return True
            else:
                when, token = self.made[token], self.left[token]

    def _arc(self, key: int, state: int, token: int) -> int:
        """The longest token with an arc out of the state among a token and the shorter ones it begins with, or -1."""
        while token >= 0 and not self._has(state, token, self.last):
            token = self.shorter[token]
        if len(self.steps) >= STEPS:
            self.steps.clear()
        self.steps[key] = token
        return token

    def encode(self, word: bytes) -> list[int]:
        whole = self.words.get(word)
        if whole is not None:
            return [whole]
        size, steps, target, shorter, lengths, best = self.size, self.steps, self.target, self.shorter, self.length, self.best
        length, reach = len(word), self.reach
        path, starts, dead = [], [], set()
        at, token = 0, -2  # -2: to be looked up
        while at < length:
            state = target[path[-1]] if path else 0
            if token == -2:
                # Whatever begins a label also does so in part, so the longest beginning is found by bisection.
                low, high = 1, min(length - at, reach) + 1
                while high - low > 1:
                    middle = low + high >> 1
                    if word[at:at + middle] in best:
                        low = middle
                    else:
                        high = middle
                token = best.get(word[at:at + low], -1)
            while token >= 0:
                key = state * size + token
                taken = steps.get(key)
                if taken is None:
                    taken = self._arc(key, state, token)
                token, stop = taken, at + lengths[taken]
                if taken < 0 or stop not in dead:
                    break
                token = shorter[token]
            if token >= 0:
                path.append(token)
                starts.append(at)
                at, token = stop, -2
            else:  # no arc leads on from here, so this position is not on the path
                dead.add(at)
                token, at = shorter[path.pop()], starts.pop()
        return path


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Text to packed token ids and back, for a byte-level vocabulary file.

    ``pieces`` makes, from the file, the map of what the pattern cuts out to packed ids; by default the automaton's.
    ``words`` is the number of words in each generation that is remembered.
    """

    def __init__(self, path: str, pieces: Callable[[str], dict[str, bytes]] | None = None, words: int | None = None):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.to_byte = {c: b for b, c in enumerate(byte_characters())}
        raw = lambda text: bytes(self.to_byte[c] for c in text)
        model = spec["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        tokens = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.pieces = pieces(path) if pieces else _Pieces(Automaton(tokens, [(raw(u), raw(v)) for u, v in pairs]).encode)
        top = max([*tokens.values(), *self.special.values()]) + 1
        self.labels = [b""] * top
        for label, token in [*tokens.items(), *((c.encode(), i) for c, i in self.special.items())]:
            self.labels[token] = label
        self.pattern, self.ascii_pattern = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
        self.runs = re.compile(f"[{SPACE}]+|[^{SPACE}]+")
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.space = frozenset(SPACE)
        self.after_blank, self.bare = _Chunks(self, " ", words or WORDS), _Chunks(self, "", PIECES)

    def missed(self, chunk: str) -> bytes:
        """The packed ids of a chunk that is not remembered."""
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isascii() or max(body) < LATIN_END:  # a word, or a word and a mark: no need to ask the pattern
            if body.isalpha():
                return packed(self.pieces.plain_ids(chunk))
            if body[-1:] in MARKS and body[:-1].isalpha():
                known = self.bare if body is chunk else self.after_blank
                return known[body[:-1]] + self.pieces[body[-1]]
        if chunk.isascii():
            return b"".join(map(self.pieces.__getitem__, self.ascii_pattern.findall(chunk)))
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = []
        for part in self.split_special.split(text):
            special = self.special.get(part)
            parts.append(self._plain(part) if special is None else special.to_bytes(4, "little"))
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        """Single blanks and line ends between words are certain cuts; a blank goes to the word behind it."""
        if not text:
            return b""
        try:
            lines, newline = [], self.bare["\n"]
            for line in text.split("\n"):
                words = line.split(" ")
                lines.append(self.bare[words[0]] + b"".join(map(self.after_blank.__getitem__, words[1:])))
            return newline.join(lines)
        except _Irregular:
            return self._irregular(text)

    def _irregular(self, text: str) -> bytes:
        """Runs of white space leave their last character to what follows, if anything does."""
        out, pending = [], ""
        runs = self.runs.findall(text)
        for at, run in enumerate(runs):
            if run[0] not in self.space:
                out.append(self.after_blank[run] if pending else self.bare[run])
                pending = ""
            elif at == len(runs) - 1:
                out.append(self.missed(run))
            else:
                if len(run) > 1:
                    out.append(self.missed(run[:-1]))
                if run[-1] == " ":
                    pending = " "
                else:
                    out.append(self.missed(run[-1]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids' arcs, joined; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class _Irregular(Exception):
    """White space that the quick split does not describe."""


class _Remembered(dict):
    """Values by key in two generations: a full one becomes the old one, and what is asked for again moves to the new.

    So it holds at most twice ``limit`` entries, and what is in use stays. Keys over 64 characters are not remembered.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.made(key)
            if len(key) > 64:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Pieces(_Remembered):
    """Packed ids of what the pattern cuts out."""

    def __init__(self, to_ids: Callable[[bytes], list[int]]):
        super().__init__(PIECES)
        self.to_ids = to_ids

    def made(self, piece: str) -> bytes:
        return packed(self.to_ids(piece.encode()))

    def plain_ids(self, chunk: str) -> list[int]:
        """The ids of a word of Latin letters, with or without a blank before it."""
        return self.to_ids(chunk.encode())


class _Chunks(_Remembered):
    """Packed ids of words, with or without a blank before them."""

    def __init__(self, encoder: Encoder, before: str, limit: int):
        super().__init__(limit)
        self.encoder, self.before = encoder, before

    def made(self, chunk: str) -> bytes:
        space = self.encoder.space
        if chunk == "\n" and not self.before:
            return self.encoder.missed(chunk)
        if not chunk or chunk[0] in space or chunk[-1] in space:
            raise _Irregular
        return self.encoder.missed(self.before + chunk)


class _LibraryPieces(_Pieces):
    """The merges of the tokenizers library, on pieces already cut by its pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        characters = byte_characters()
        self.tokenize, self.blank = Tokenizer.from_file(path).model.tokenize, characters[ord(" ")]
        printed = str.maketrans(dict(enumerate(characters)))
        super().__init__(lambda piece: [t.id for t in self.tokenize(piece.decode("latin-1").translate(printed))])

    def made(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # these characters stand for themselves, but for the blank
            return packed(self.plain_ids(piece))
        return super().made(piece)

    def plain_ids(self, chunk: str) -> list[int]:
        if not chunk.isascii():
            return self.to_ids(chunk.encode())
        return [t.id for t in self.tokenize(chunk.replace(" ", self.blank))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One automaton encoder per Python worker and file."""
    return Encoder(path)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """The same with the tokenizers library's merges in place of the automaton."""
    return Encoder(path, _LibraryPieces, LIBRARY_WORDS)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row: the token ids as little-endian unsigned 32-bit integers.

    ``path`` is a byte-level BPE file that every executor can open under the same name. A null text counts
    as an empty one. Rows are encoded where they are read: nothing is shuffled, rows of
    one id stay separate rows, and a text of any length is one row's work.
    """
    def work(batch: pa.RecordBatch) -> dict:
        to_ids = encoder(path).encode
        return {"doc_id": batch["doc_id"], "ids": pa.array([to_ids(t or "") for t in batch["text"].to_pylist()], pa.binary())}

    return map_arrow(only(docs, doc_id=id_column, text=text_column), work, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``text``, decoded from ``ids``, to ``doc_id, ids``."""
    def work(batch: pa.RecordBatch) -> dict:
        to_text = encoder(path).decode
        return {"doc_id": batch["doc_id"], "ids": batch["ids"],
                "text": [to_text(i or b"") for i in batch["ids"].to_pylist()]}

    return map_arrow(encoded.select("doc_id", "ids"), work, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of a round trip through the automaton.

    Nulls, empty and long texts and repeated ids are as in ``encode``. Both ways are one pass of one worker, which holds
    the ids and the decoded text of one document at a time.
    """
    def work(batch: pa.RecordBatch) -> dict:
        coder, n_tokens, both = encoder(path), [], ([], [])
        for text in batch["text"]:
            ids = coder.encode(text.as_py() or "")
            n_tokens.append(len(ids) // 4)
            for out, data in zip(both, (ids, coder.decode(ids).encode())):
                out.append(hashlib.sha256(data).hexdigest())
        return {"doc_id": batch["doc_id"], "n_tokens": n_tokens, "ids_sha256": both[0], "decoded_sha256": both[1]}

    return map_arrow(only(docs, doc_id=id_column, text=text_column), work,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
