"""Secrets in texts: named assignments, access ids and hex strings by pattern, keys and signed tokens by their structure.

A pattern alone cannot tell a private key from any other base64 or hex text. Such candidates are decoded and parsed, and
reported only if the structure closes: in DER every nested length must fill its parent exactly and the fields must be those
of a key encoding; in the OpenSSH container every length-prefixed string must fit; a signed token needs a JSON
header that names a known algorithm, a JSON payload and a signature of that algorithm's length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.support import map_arrow, only

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "token")  # in this order where spans begin together

#: Fixed patterns of the base kinds. Letters of the names match in either case, as ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of at least 24; a shorter run holds no such part
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,60})-----")
RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
LONG_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])e[wy][A-Za-z0-9_-]*\.[A-Za-z0-9_.-]+")
#: How a JSON object begins in base64: a brace, then a quotation mark or white space.
BRACE = ("eyJ", "eyA", "ewo", "ew0", "ewk")
#: Fixed: bytes in the signature of an algorithm; RSA signatures are as long as the key, 1024 bits or more.
SIGNATURES = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,),
              "ES512": (132,), "EdDSA": (64, 114)}
RSA = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
#: Fixed: DER tags, and the prefixes of the password-based encryption identifiers (PKCS 5 and PKCS 12).
INTEGER, OCTETS, OID, SEQUENCE, CONTEXT_0, CONTEXT_1 = 0x02, 0x04, 0x06, 0x30, 0xA0, 0xA1
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c"))
CONTAINER = b"openssh-key-v1\0"
DEEPEST = 16  # levels of nesting; key encodings have at most six


def fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) pairs that fill ``data`` exactly, or None."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length > 0x80:
            size = length & 0x7F
            length = int.from_bytes(data[at:at + size], "big")
            if size > 4 or at + size > len(data) or length < 0x80 or length >> 8 * (size - 1) == 0:
                return None  # not the shortest form
            at += size
        elif length == 0x80:
            return None  # no length at all
        if at + length > len(data):
            return None
        found.append((tag, data[at:at + length]))
        at += length
    return found


def closes(data: bytes, depth: int = DEEPEST) -> bool:
    """Whether the lengths of all nested constructed fields fit."""
    inner = fields(data) if depth else None
    return inner is not None and all(closes(content, depth - 1) for tag, content in inner if tag & 0x20)


def key_encoding(data: bytes) -> str | None:
    """The name of the private-key encoding that ``data`` is, or None."""
    if data.startswith(CONTAINER):
        return _container(data)
    outer = fields(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1 or not closes(data):
        return None
    parts = fields(outer[0][1])
    tags = [tag for tag, _ in parts]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and all(t in (CONTEXT_0, CONTEXT_1, 0x81) for t in tags[3:]):
        algorithm = fields(parts[1][1])
        if parts[0][1] in (b"\0", b"\1") and algorithm and algorithm[0][0] == OID and fields(parts[2][1]):
            return "pkcs8"
    elif tags == [SEQUENCE, OCTETS]:
        algorithm = fields(parts[0][1])
        if algorithm and algorithm[0][0] == OID and algorithm[0][1].startswith(ENCRYPTION) and len(parts[1][1]) >= 16:
            return "pkcs8-encrypted"
    elif tags[:2] == [INTEGER, OCTETS] and all(t in (CONTEXT_0, CONTEXT_1) for t in tags[2:]):
        if parts[0][1] == b"\1" and 20 <= len(parts[1][1]) <= 66:
            return "sec1"
    elif tags in ([INTEGER] * 9, [INTEGER] * 9 + [SEQUENCE], [INTEGER] * 6) and parts[0][1] in (b"\0", b"\1"):
        numbers = [content for _, content in parts[1:] if content]
        if len(numbers) == len(parts) - 1 and all(n[0] < 0x80 for n in numbers) and len(parts[1][1]) >= 64:
            return "pkcs1" if len(tags) > 6 else "dsa"
    return None


def _container(data: bytes) -> str | None:
    """An OpenSSH key file: three strings, a count, that many public keys, one private part, nothing behind it."""
    at, strings = len(CONTAINER), []

    def number() -> int:
        nonlocal at
        if at + 4 > len(data):
            raise ValueError
        at += 4
        return int.from_bytes(data[at - 4:at], "big")

    def string() -> bytes:
        nonlocal at
        size = number()
        if at + size > len(data):
            raise ValueError
        at += size
        return data[at - size:at]

    try:
        cipher, _, _ = string(), string(), string()
        count = number()
        if not 1 <= count <= len(data) // 4:
            return None
        strings = [string() for _ in range(count)]
        private = string()
    except ValueError:
        return None
    if at != len(data) or not all(strings) or not private or len(private) % 8:
        return None
    if cipher == b"none" and private[:4] != private[4:8]:
        return None
    return "openssh" if cipher == b"none" else "openssh-encrypted"


def unpacked(run: str) -> bytes:
    """The bytes of base64 text in either alphabet, padded or not; empty if it is none."""
    run = run.rstrip("=").translate(_ALPHABET)
    if len(run) % 4 == 1:
        return b""
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return b""


_ALPHABET = str.maketrans("-_", "+/")


def token_algorithm(run: str) -> str | None:
    """The algorithm of a signed token (header, payload and signature with dots between), or None."""
    parts = run.split(".")
    if len(parts) != 3 or not all(parts):
        return None
    header, payload, signature = map(unpacked, parts)
    try:
        head, body = json.loads(header), json.loads(payload)
    except (ValueError, RecursionError):
        return None
    name = head.get("alg") if isinstance(head, dict) else None
    if not isinstance(name, str) or not isinstance(body, dict):
        return None
    fits = len(signature) >= 128 if name in RSA else len(signature) in SIGNATURES.get(name, ())
    return name if fits else None


def base_spans(text: str) -> Iterator[tuple[int, int, str]]:
    small = text.lower()
    if any(name in small for name in NAMES):
        yield from ((*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6)
    if "AKIA" in text:
        yield from ((*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20)
    yield from ((*m.span(), "hex") for m in HEX.finditer(text))


def confirmed_spans(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Armoured keys with their marks, bare keys in base64 or hex, and signed tokens, each with what it was parsed as."""
    armoured = []
    if "-----BEGIN " in text:
        begin = None
        for mark in ARMOUR.finditer(text):
            if mark[1] == "BEGIN":
                begin = mark
            elif begin is not None and begin[2] == mark[2]:
                body = re.sub(r"\s|\\[nr]", "", text[begin.end():mark.start()])
                name = key_encoding(unpacked(body))
                if name:
                    armoured.append((begin.start(), mark.end()))
                    yield begin.start(), mark.end(), "key", name
                begin = None
    behind = 0
    for run in RUN.finditer(text):
        while behind < len(armoured) and armoured[behind][1] <= run.start():
            behind += 1
        if behind < len(armoured) and armoured[behind][0] <= run.start():
            continue
        name = key_encoding(unpacked(run[0]))
        if name:
            yield *run.span(), "key", name
            continue
        for digits in LONG_HEX.finditer(run[0]):
            name = key_encoding(bytes.fromhex(digits[0])) if len(digits[0]) % 2 == 0 else None
            if name:
                yield run.start() + digits.start(), run.start() + digits.end(), "key", name
    if any(b in text for b in BRACE):
        for m in SIGNED.finditer(text):
            for candidate in (m[0].rstrip("."), m[0].rstrip(".-")):  # the end of a sentence or a dash may follow
                name = token_algorithm(candidate)
                if name:
                    yield m.start(), m.start() + len(candidate), "token", name
                    break


def spans(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """``(kind, start, stop, detail)`` in order; offsets are code points, ``stop`` is exclusive."""
    if not text:
        return []
    found = [(start, KINDS.index(kind), stop, None) for start, stop, kind in base_spans(text)]
    found += [(start, KINDS.index(kind), stop, detail) for start, stop, kind, detail in confirmed_spans(text)]
    return [(KINDS[kind], start, stop, detail) for start, kind, stop, detail in sorted(found, key=lambda s: s[:3])]


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: the kind, place and, for confirmed ones, the encoding or algorithm of each secret.

    A null or empty text has no spans; rows of one id stay separate rows. Rows are scanned where they are read.
    """
    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch["doc_id"], "spans": [spans(text) for text in batch["text"].to_pylist()]}

    return map_arrow(only(docs, doc_id=id_column, text=text_column), work,
                     "doc_id long, spans array<struct<kind:string,start:long,stop:long,detail:string>>")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: counts of the base kinds, and spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scan(docs, id_column, text_column).select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
