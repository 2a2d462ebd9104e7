"""WARC archives as a Spark data source, and pages archived with revisit records.

``spark.read.format("warc")`` reads ``*.warc`` and ``*.warc.gz`` below a folder. Every file is
planned as ranges of whole records: the writer leaves an index (``.idx``, a line of fixed width
with offset, length and type per record) beside each file, so large files are split and records
of unwanted types are not even opened; files without an index are one partition each. Equality and
IN filters on ``record_type`` and on header columns are pushed down; a record's headers are parsed
first, and the payload of a record that they rule out is skipped without being decoded, as
are all payloads when ``payload`` is ``false``.

The writer rolls files at ``roll_bytes``. Each record is a gzip member of its own. A file's name starts with
``_`` and it counts only if a manifest names it, which the driver writes when all tasks are done: one small
file, no renames, and what a failed or repeated task leaves is never read. Other ``*.warc`` and ``*.warc.gz`` files of
a folder are read as they are.

Defined cases of ``archive_pages``: a null html is an empty payload; a null page_id is smaller
than all others; rows that share a page_id are records of their own, and those that share the smallest
page_id of a payload are all responses; an empty table gives an empty archive; other columns are
ignored; payloads have no length limit.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from tripmill.llm.common import has_columns, read
from tripmill.session import scratch_dir

#: Production parameters: smallest payload that is revisited, bytes after which a file is rolled, bytes planned per partition.
MIN_REVISIT, ROLL_BYTES, PARTITION_BYTES = 0, 64 << 20, 16 << 20
#: The header line of a column.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
    "payload_length": "X-Payload-Length",
}
#: Bytes of a line of an index: offset, length and type of a record.
INDEX_LINE = 47
_MANIFEST = re.compile(r"manifest-[0-9a-f]{32}\.txt")
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"
#: Fixed date, so that archives of the same pages are equal.
DATE = "1970-01-01T00:00:00Z"


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Range(InputPartition):
    """Records of one file, from the first to before the last by their index, or all of the file."""

    def __init__(self, file: str, records: tuple[int, int] | None) -> None:
        self.file, self.records = file, records


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]) -> None:
        self.uri, self.columns = options["path"], columns
        self.payload = options.get("payload", "true") == "true"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                values = {f.value}
            elif column in HEADERS and isinstance(f, In):
                values = set(f.value)
            else:
                yield f
                continue
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> list[Range]:
        """From names and sizes alone: the indexes stay with the executors."""
        from pyarrow import fs

        store, top = _store(self.uri)
        found = {x.path: x.size for x in store.get_file_info(fs.FileSelector(top, recursive=True))}
        named = set()
        for name in found:
            if _MANIFEST.fullmatch(name.rsplit("/", 1)[-1]):
                with store.open_input_stream(name) as stream:
                    folder = name.rsplit("/", 1)[0]
                    named |= {f"{folder}/{line}" for line in stream.read().decode().split()}
        out = []
        archives = (n for n in found if re.search(r"\.warc(\.gz)?$", n))
        for name in sorted(n for n in archives if n in named or not n.rsplit("/", 1)[-1].startswith("_")):
            n = found.get(f"{name}.idx", 0) // INDEX_LINE
            if not n:
                out.append(Range(name, None))
                continue
            parts = min(n, max(1, found[name] // self.partition_bytes))
            out += [Range(name, (k * n // parts, (k + 1) * n // parts)) for k in range(parts)]
        return out

    def read(self, partition: Range | None):
        if partition is None:  # an empty archive: Spark asks for one partition all the same
            return
        store, _ = _store(self.uri)
        rows: list[tuple] = []
        held = 0
        with store.open_input_file(partition.file) as file:
            for headers, payload in self._records(file, partition):
                rows.append((*(headers.get(HEADERS[c].lower()) for c in HEADERS), payload))
                held += len(payload or b"")
                if len(rows) == 2000 or held > 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _records(self, file, partition: Range) -> Iterator[tuple[dict, bytes | None]]:
        if partition.records is None:
            raw = gzip.GzipFile(fileobj=file) if partition.file.endswith(".gz") else file
            yield from self._stream(raw)
            return
        first, last = partition.records
        with _store(self.uri)[0].open_input_file(f"{partition.file}.idx") as index:
            lines = index.read_at((last - first) * INDEX_LINE, first * INDEX_LINE).decode().splitlines()
        types = self.wanted.get("record_type")
        for line in lines:
            kind = line[34:].strip()
            if types is not None and kind not in types:
                continue
            offset, length = int(line[:16], 16), int(line[17:33], 16)
            member = file.read_at(length, offset)
            if not partition.file.endswith(".gz"):
                head, _, rest = member.partition(b"\r\n\r\n")
                headers = _headers(head)
                if self._keeps(headers):
                    yield headers, rest[: int(headers["content-length"])] if self.payload else None
                continue
            # The headers are inflated first, the payload only if they pass.
            inflater, head = zlib.decompressobj(31), b""
            feed = member
            while b"\r\n\r\n" not in head and feed:
                head += inflater.decompress(feed, 4096)
                feed = inflater.unconsumed_tail
            head, _, rest = head.partition(b"\r\n\r\n")
            headers = _headers(head)
            if self._keeps(headers):
                size = int(headers["content-length"])
                body = (rest + inflater.decompress(feed) + inflater.flush())[:size] if self.payload else None
                yield headers, body

    def _stream(self, raw) -> Iterator[tuple[dict, bytes | None]]:
        """Records one after the other, where no index tells where they are."""
        import io

        buffered = io.BufferedReader(raw) if isinstance(raw, gzip.GzipFile) else raw
        readline = buffered.readline
        while line := readline():
            if not line.strip():
                continue
            lines = [line]
            while (line := readline()).strip():
                lines.append(line)
            headers = _headers(b"".join(lines))
            size = int(headers["content-length"])
            if self._keeps(headers) and self.payload:
                yield headers, buffered.read(size)
                continue
            while size:  # passed over in small parts
                size -= len(buffered.read(min(size, 1 << 16))) or size
            if self._keeps(headers):
                yield headers, None

    def _keeps(self, headers: dict) -> bool:
        return all(headers.get(HEADERS[c].lower()) in values for c, values in self.wanted.items())


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").splitlines()
    if not lines or not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {head[:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name.strip()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.string()] * len(HEADERS) + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*HEADERS, "payload"]
    )


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class WarcWriter(DataSourceWriter):
    """Rows of the reader's columns to files; a null payload is an empty one."""

    def __init__(self, options: dict, columns: list[str]) -> None:
        self.uri, self.columns = options["path"].rstrip("/"), columns
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))

    def write(self, iterator) -> Written:
        store, top = _store(self.uri)
        store.create_dir(top, recursive=True)
        files: list[str] = []
        out, index, at = None, [], 0

        def close() -> None:
            out.close()
            with store.open_output_stream(f"{files[-1]}.idx") as stream:
                stream.write("".join(f"{o:016x} {n:016x} {t:<12.12}\n" for o, n, t in index).encode())

        for row in iterator:
            if out is None or at >= self.roll:
                if out is not None:
                    close()
                files.append(f"{top}/_{uuid.uuid4().hex}.warc.gz")
                out, index, at = store.open_output_stream(files[-1], compression=None), [], 0
            member = record(row.asDict())
            out.write(member)
            index.append((at, len(member), row["record_type"]))
            at += len(member)
        if out is not None:
            close()
        return Written(files)

    def commit(self, messages) -> None:
        store, top = _store(self.uri)
        store.create_dir(top, recursive=True)
        names = [file.rsplit("/", 1)[-1] for message in messages if message for file in message.files]
        draft = f"{top}/{uuid.uuid4().hex}.draft"
        with store.open_output_stream(draft) as stream:
            stream.write("".join(f"{name}\n" for name in names).encode())
        store.move(draft, f"{top}/manifest-{uuid.uuid4().hex}.txt")

    def abort(self, messages) -> None:
        store, _ = _store(self.uri)
        for message in messages:
            for file in message.files if message else ():
                for name in (file, f"{file}.idx"):
                    if store.get_file_info(name).is_file:
                        store.delete_file(name)


def record(row: dict) -> bytes:
    """One gzip member."""
    payload = bytes(row.get("payload") or b"")
    lines = ["WARC/1.1", *(f"{HEADERS[c]}: {row[c]}" for c in HEADERS if row.get(c) is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(payload)}", "", ""]).encode()
    return gzip.compress(head + payload + b"\r\n\r\n", 4, mtime=0)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options, schema.names)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32_of_hex(digits):
    """A SHA-1 of 40 hexadecimal digits in 32 base32 characters: 20 bits give 4 of them."""
    alphabet, out = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", []
    for k in range(0, 40, 5):
        bits = F.conv(F.substring(digits, k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substring(F.lit(alphabet), place, F.lit(1)))
    return F.concat(*out)


def _urn(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_of(urn):
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame, uri: str, min_revisit: int = MIN_REVISIT) -> None:
    """Writes a record per page; equal payloads of at least ``min_revisit`` bytes once.

    Equal payloads are found from digests, counted before their shuffle; the html is shuffled once,
    by page, so that a payload which a third of the pages share is no hot key.
    """
    has_columns(pages, "page_id", "html")
    register(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(url, "[\r\n]", " ").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.sha1(payload).alias("sha"),
    )
    known = rows.select("page_id", "size", "sha")
    smallest = F.min(F.struct(F.col("page_id").isNotNull().alias("set"), F.col("page_id").alias("id")))
    first = (
        known.where(F.col("size") >= min_revisit)
        .groupBy("sha")
        .agg(smallest.alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", F.col("first.id").alias("first_id"))
    )
    again = (
        known.join(first, "sha")
        .where(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "first_id", F.lit(True).alias("again"))
        .distinct()
    )
    placed = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha")), "left")
    records = placed.select(
        F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
        _urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.concat(F.lit("sha1:"), base32_of_hex(F.upper("sha"))).alias("payload_digest"),
        F.when(F.col("again"), _urn(F.col("first_id"))).alias("refers_to"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.col("size").cast("string").alias("payload_length"),
        F.when(F.col("again"), F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )
    records.write.format("warc").mode("append").option("path", uri).save()


def read_archive(spark: SparkSession, uri: str) -> DataFrame:
    """A row per record; a response whose payload isn't what its digest says is an error."""
    register(spark)
    rows = spark.read.format("warc").load(uri)
    digest = F.regexp_replace("payload_digest", "^sha1:", "")
    response = F.col("record_type") == "response"
    sound = ~response | (base32_of_hex(F.upper(F.sha1("payload"))) == digest)
    return rows.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length").cast("long")).cast("long").alias("payload_bytes"),
        F.when(sound, digest).otherwise(F.raise_error(F.concat(F.lit("damaged payload: "), "record_id"))).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


def op4_warc(spark, sf_dir):
    """All pages written to WARC archives and read back."""
    uri = scratch_dir(spark, "warc")
    archive_pages(read(spark, sf_dir, "pages"), uri)
    return read_archive(spark, uri)


ORACLE = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
judged AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM sized)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM judged
"""
