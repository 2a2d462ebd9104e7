"""Token ids in files of fixed-width bit packing.

A file holds whole documents in ascending doc_id. Ids take the fewest bits that hold the
vocabulary, in blocks of ``BLOCK`` ids; 64 ids fill ``width`` 64-bit words, so numpy packs and
unpacks a block in 64 shifts. A footer has the offset of every block, the doc_id and the first
id of every document, so any document or range of ids is read without the rest.

    "TPK1" | width u32 | blocks ... | doc_ids i64[n] | null_ids u8[n] | starts i64[n+1] |
    block offsets i64[blocks+1] | n u64 | ids u64 | blocks u64 | "TPK1"

Files go to any storage that ``pyarrow.fs`` opens by URI and every executor reaches. A task writes
under a name of its own and moves the file into place when it is complete; only files named by
the tasks that succeeded are read.

Defined cases: a null text is empty and holds only the end id; a null doc_id sorts first and is
read back as null; rows that share a doc_id stay rows of their own, ordered by a hash of their texts; an empty
table writes no file; other columns are ignored. A text may be longer than a block or a file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, lean, read, written
from tripmill.llm.tokens import encoder, vocabulary_path
from tripmill.session import scratch_dir

#: Production parameters: id that ends a document, ids in a block (a multiple of 64) and about in a file.
END_ID, BLOCK, FILE_IDS = 2, 1 << 16, 1 << 22
MAGIC = b"TPK1"
#: Bytes of text encoded together; a longer text is encoded alone.
SLICE_BYTES = 4 << 20


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids of ``width`` bits each, padded with zeros to a multiple of 64 ids."""
    rows = np.zeros((ceil(len(ids) / 64), 64), dtype="<u8")
    rows.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(rows), width), dtype="<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[:, word] |= rows[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, k] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    words = np.frombuffer(raw, dtype="<u8").reshape(-1, width)
    rows = np.empty((len(words), 64), dtype="<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        rows[:, k] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            rows[:, k] |= words[:, word + 1] << np.uint64(64 - shift)
    rows &= np.uint64((1 << width) - 1)
    return rows.reshape(-1)[:n].astype("<u4")


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str) -> None:
        store, path = _store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self._at(size - 28, 28)
        if tail[24:] != MAGIC or self._at(0, 4) != MAGIC:
            raise ValueError(f"{uri} is not a complete token file")
        self.width = int(np.frombuffer(self._at(4, 4), "<u4")[0])
        self.n_docs, self.n_ids, blocks = (int(x) for x in np.frombuffer(tail[:24], "<u8"))
        n, at = self.n_docs, size - 28
        sizes = (8 * n, n, 8 * (n + 1), 8 * (blocks + 1))
        at -= sum(sizes)
        parts = []
        for length in sizes:
            parts.append(self._at(at, length))
            at += length
        self.doc_ids, self.starts, self.offsets = (np.frombuffer(parts[i], "<i8") for i in (0, 2, 3))
        self.null_ids = np.frombuffer(parts[1], "u1").astype(bool)

    def _at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def block(self, k: int) -> np.ndarray:
        raw = self._at(int(self.offsets[k]), int(self.offsets[k + 1] - self.offsets[k]))
        return unpack(raw, self.width, min(BLOCK, self.n_ids - k * BLOCK))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // BLOCK, (stop - 1) // BLOCK
        some = [self.block(k) for k in range(first, last + 1)]
        return np.concatenate(some)[start - first * BLOCK : stop - first * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order; each block is read once."""
        held, first = np.empty(0, "<u4"), 0
        for k in range(self.n_docs):
            start, stop = int(self.starts[k]), int(self.starts[k + 1])
            held, first = held[start - first :], start
            more = [held]
            have = first + len(held)
            while have < stop:
                more.append(self.block(have // BLOCK))
                have += len(more[-1])
            held = np.concatenate(more) if len(more) > 1 else held
            yield None if self.null_ids[k] else int(self.doc_ids[k]), held[: stop - start]


def _write_file(uri: str, width: int, documents: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Documents with their ids as unsigned 32-bit bytes; the numbers of documents and of ids."""
    store, path = _store(uri)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    doc_ids, nulls, starts, offsets, waiting, n = [], [], [0], [8], [], 0
    with store.open_output_stream(draft) as out:
        out.write(MAGIC + np.uint32(width).tobytes())

        def flush(all_of_it: bool) -> None:
            nonlocal waiting
            ids = np.concatenate(waiting) if waiting else np.empty(0, "<u4")
            stop = len(ids) if all_of_it else len(ids) - len(ids) % BLOCK
            for k in range(0, stop, BLOCK):
                raw = pack(ids[k : min(k + BLOCK, stop)], width)
                out.write(raw)
                offsets.append(offsets[-1] + len(raw))
            waiting = [ids[stop:]]

        held = 0
        for doc_id, raw in documents:
            doc_ids.append(doc_id or 0)
            nulls.append(doc_id is None)
            waiting.append(np.frombuffer(raw, "<u4"))
            n += len(waiting[-1])
            held += len(waiting[-1])
            starts.append(n)
            if held >= 4 * BLOCK:
                flush(False)
                held = len(waiting[0])
        flush(True)
        for values, kind in ((doc_ids, "<i8"), (nulls, "u1"), (starts, "<i8"), (offsets, "<i8")):
            out.write(np.asarray(values, dtype=kind).tobytes())
        out.write(np.asarray([len(doc_ids), n, len(offsets) - 1], dtype="<u8").tobytes() + MAGIC)
    store.move(draft, path)
    return len(doc_ids), n


def texts_of(docs: DataFrame) -> DataFrame:
    has_columns(docs, "doc_id", "text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ids_of_texts(batch: pa.RecordBatch, vocabulary: str, end: bytes) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of (doc_id, text) and the ids of their texts, with the end id."""
    ids_of = encoder(vocabulary).encode
    texts = pc.fill_null(batch.column(1), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    start, done = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start), [raw + end for raw in ids_of(texts.slice(start, stop - start))]
        start, done = stop, int(ends[stop - 1])


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id and ids (unsigned 32-bit bytes) of every document, with the end id."""
    end = np.uint32(end_id).tobytes()

    def run(batches):
        for batch in batches:
            for some, ids in ids_of_texts(batch, vocabulary, end):
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"],
                )

    return texts_of(docs).mapInArrow(lean(run), "doc_id long, n_tokens long, ids binary")


def write_token_files(
    docs: DataFrame, uri: str, vocabulary: str, end_id: int = END_ID, file_ids: int = FILE_IDS
) -> DataFrame:
    """Writes the files below ``uri``; a row per file: part, file, n_docs, n_ids.

    The texts are ordered, and encoded and packed in the same task: ids are never written but packed. Files get about
    ``file_ids`` ids, at four bytes of text each.
    """
    rows = texts_of(docs)
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 4)).first()[0] or 0
    width = max(1, int(encoder(vocabulary).size - 1).bit_length(), int(end_id).bit_length())
    end = np.uint32(end_id).tobytes()
    _store(uri)[0].create_dir(_store(uri)[1], recursive=True)

    def run(batches):
        part = TaskContext.get().partitionId()

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for some, ids in ids_of_texts(batch, vocabulary, end):
                    yield from zip(some.column(0).to_pylist(), ids)

        found = documents()
        first = next(found, None)
        if first is None:
            return
        name = f"{uri}/part-{part:06d}-{uuid.uuid4().hex}.tpk"
        n_docs, n_ids = _write_file(name, width, chain([first], found))
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]})

    keyed = rows.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    parts = max(1, ceil(total / (4 * file_ids)))
    ordered = keyed.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return written(ordered.mapInArrow(lean(run), "part long, file string, n_docs long, n_ids long"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = TokenFile(name)
                out: list[tuple] = []
                for k, (doc_id, ids) in enumerate(held.documents()):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    out.append((doc_id, base + int(held.starts[k]), len(ids), crc))
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    tasks = max(1, files.count())
    return placed.repartition(tasks, "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op8_token_files(spark, sf_dir):
    """All documents written as bit-packed ids and read back."""
    docs = read(spark, sf_dir, "documents")
    uri = scratch_dir(spark, "token-files")
    return read_token_files(write_token_files(docs, uri, vocabulary_path()))
