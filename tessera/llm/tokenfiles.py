"""Token ids as flat binary files with 64-bit document offsets, written by tasks and read through memory maps.

A data set is a folder of parts and a manifest. Part files hold documents in ascending order of id:

* ``NAME.ids``   token ids, little-endian unsigned 16-bit integers, 32-bit if the vocabulary has more ids
* ``NAME.off``   n + 1 little-endian unsigned 64-bit offsets: where each document begins in its part, and the end
* ``NAME.doc``   n little-endian signed 64-bit document ids
* ``NAME.nul``   n bytes, 1 where the document has no id

The manifest has a row per part: number, name, documents and tokens, and the prefix sums of both over the parts before
it, so a document's place in the whole is its part's base plus its offset. A repeated task writes under a new name,
and only parts of successful tasks are in the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm.bytepairs import library_encoder
from tessera.llm.support import give_back, only
from tessera.session import fresh_path, shuffle_width, written

MANIFEST = "part int, name string, width int, n_docs long, n_tokens long"


def write(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Write ``docs`` to ``folder``, which all machines must reach, and return the manifest.

    Every document is followed by ``end_id``. A null text counts as an empty one. Rows without an id
    come first; rows of one id follow each other in the order of their texts' hashes.
    """
    source = only(docs, doc_id=id_column, text=text_column).withColumn("digest", F.xxhash64("text"))
    placed = source.repartitionByRange(shuffle_width(docs.sparkSession), "doc_id", "digest").sortWithinPartitions(
        "doc_id", "digest")
    schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()),
                        ("n_tokens", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, store, files = TaskContext.get().partitionId(), None, None, {}
        n_docs = n_tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = library_encoder(vocabulary)
                width = 2 if max(len(encoder.labels), end_id + 1) <= 1 << 16 else 4
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                files = {kind: store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("ids", "off", "doc", "nul")}
                files["off"].write(bytes(8))
                end = int(end_id).to_bytes(4, "little")
            packed = [encoder.encode(text or "") + end for text in batch["text"].to_pylist()]
            lengths = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
            ids = np.frombuffer(b"".join(packed), "<u4")
            files["ids"].write(ids.astype(f"<u{width}").tobytes())
            files["off"].write((n_tokens + np.cumsum(lengths)).astype("<u8").tobytes())
            files["doc"].write(batch["doc_id"].fill_null(0).to_numpy().astype("<i8").tobytes())
            files["nul"].write(batch["doc_id"].is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            n_docs, n_tokens = n_docs + len(packed), n_tokens + len(ids)
            del packed, ids
            give_back()
        for file in files.values():
            file.close()
        if encoder is not None:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "name": name, "width": width, "n_docs": n_docs, "n_tokens": n_tokens}], schema=schema)

    parts = written(placed.mapInArrow(work, MANIFEST), "parts")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return written(parts.select(
        "*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"base_{c[2:]}") for c in ("n_docs", "n_tokens")]), "manifest")


class Part:
    """The arrays of one part: memory-mapped where the store is a file system, else read piece by piece."""

    def __init__(self, folder: str, name: str, width: int):
        self.store, root = fs.FileSystem.from_uri(folder)
        self.stem = f"{root}/{name}"
        self.kind = f"<u{width}"

    def array(self, suffix: str, kind: str, start: int = 0, stop: int | None = None) -> np.ndarray:
        path = f"{self.stem}.{suffix}"
        if isinstance(self.store, fs.LocalFileSystem):
            return np.memmap(path, kind, "r")[start:stop]
        size = np.dtype(kind).itemsize
        with self.store.open_input_file(path) as file:
            stop = file.size() // size if stop is None else stop
            return np.frombuffer(file.read_at((stop - start) * size, start * size), kind)

    def documents(self, some: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of documents: ids, whether they are missing, offsets (one more), tokens."""
        offsets = self.array("off", "<u8").astype(np.int64)
        docs, missing = self.array("doc", "<i8"), self.array("nul", "u1")
        for start in range(0, len(docs), some):
            stop = min(start + some, len(docs))
            here = offsets[start:stop + 1]
            yield docs[start:stop], missing[start:stop] == 1, here, self.array("ids", self.kind, here[0], here[-1])


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of a data set: ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for docs, missing, offsets, tokens in Part(folder, row["name"], row["width"]).documents():
                    wide = tokens.astype("<u4").tobytes()
                    cuts = (4 * (offsets - offsets[0])).tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs, pa.int64(), mask=missing), pa.array(row["base_tokens"] + offsets[:-1], pa.int64()),
                        pa.array([wide[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())], schema=schema)

    spread = manifest.select("name", "width", "base_tokens").repartition(shuffle_width(manifest.sparkSession))
    return spread.mapInArrow(work, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    folder = fresh_path(docs.sparkSession, "tokens")
    return read(write(docs, vocabulary, folder, end_id), folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
