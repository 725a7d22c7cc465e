"""WARC archives as a data source, and a page table's round trip through them."""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from tidegauge.llm.common import all_pieces, settled, stored

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_length long, content_type string, payload binary"
)
# Header of each column that is not the payload; a predicate on one is decided before the block
# is touched.
_HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "payload_length": "x-payload-length",
    "content_type": "content-type",
}
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PACKED = 64 << 20
_SENT = 8 << 20
_COPIED = 1 << 20
SMALLEST = 100


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    """What a task has written under a name that readers pass over."""

    paths: list[str]


class Warc(DataSource):
    """Reads `*.warc` and `*.warc.gz` below a path, and appends such files to it.

    Options: `path` (anything pyarrow's file systems open: all executors must reach it), `compression`
    (`none` or `gzip`, one member a record) and `rollover` (bytes after which a writer starts a new file).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("warc files are only appended to; write to a new path")
        return WarcWriter(
            self.options["path"],
            self.options.get("compression", "none"),
            int(self.options.get("rollover", _PACKED)),
        )


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path = path
        self.names = [field.name for field in schema.fields]
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over what headers decide: equality, membership, prefixes and presence."""
        for one in filters:
            column = getattr(one, "attribute", ())
            if len(column) != 1 or column[0] not in _HEADERS:
                yield one
            elif isinstance(one, EqualTo) and one.value is not None:
                self.tests.append((column[0], "in", {one.value}))
            elif isinstance(one, In):
                self.tests.append((column[0], "in", set(one.value) - {None}))
            elif isinstance(one, StringStartsWith):
                self.tests.append((column[0], "starts", one.value))
            elif isinstance(one, IsNotNull):
                self.tests.append((column[0], "there", None))
            else:
                yield one

    def partitions(self) -> list[Files]:
        """Files packed to about 64 MB; a record never spans tasks, a file is read from its start.

        Without files there is one empty pack, since Spark hands a reader without partitions None.
        """
        system, root = _place(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted(
            (-f.size, f.path) for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz"))
        )
        packs: list[Files] = []
        held = _PACKED
        for size, path in files:
            if held - size >= _PACKED:
                packs.append(Files([]))
                held = 0
            packs[-1].paths.append(path)
            held -= size
        return packs or [Files([])]

    def _wanted(self, values: dict[str, object]) -> bool:
        for column, kind, what in self.tests:
            value = values[column]
            if value is None:
                return False
            if kind == "in" and value not in what:
                return False
            if kind == "starts" and not str(value).startswith(what):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _place(self.path)
        kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
        columns: dict[str, list] = {name: [] for name in self.names}
        held = 0

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(columns[n], kinds.get(n, pa.string())) for n in self.names], self.names
            )
            for values in columns.values():
                values.clear()
            return made

        rows = 0
        for path in partition.paths:
            with _opened(system, path) as stream:
                for values, block in records(stream, path, self._wanted, "payload" in columns):
                    for name in self.names:
                        columns[name].append(block if name == "payload" else values[name])
                    held += 300 + len(block or b"")
                    rows += 1
                    if held >= _SENT:
                        yield batch()
                        held = rows = 0
        if rows:
            yield batch()


def _opened(system: pafs.FileSystem, path: str):
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=system.open_input_stream(path, compression=None))
    return io.BufferedReader(system.open_input_file(path), _COPIED)


def _headers(stream, path: str) -> dict[str, str] | None:
    """Header lines of the next record, by lower-case name; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{path}: no WARC record where one should begin: {line[:40]!r}")
    found: dict[str, str] = {}
    last = None
    while True:
        line = stream.readline()
        if not line:
            raise ValueError(f"{path}: it ends within a record's headers")
        line = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not line:
            return found
        if line[0] in " \t" and last:
            found[last] += " " + line.strip()
            continue
        last, _, value = line.partition(":")
        last = last.strip().lower()
        found[last] = value.strip()


def _uri(url: str) -> str:
    """Blanks and control characters, which no URI holds, become percent codes and stay so."""
    return "".join(quote(c) if c.isspace() or not c.isprintable() else c for c in url)


def _skip(stream, size: int) -> None:
    if isinstance(stream, io.BufferedReader):
        stream.seek(size, io.SEEK_CUR)
        return
    while size > 0:
        got = len(stream.read(min(size, _COPIED)))
        if not got:
            return
        size -= got


def records(
    stream, path: str, wanted=lambda values: True, payload: bool = True
) -> Iterator[tuple[dict[str, object], bytes | None]]:
    """Header values of each wanted record, with the payload if asked for.

    Headers come first; the block of a record that is not wanted, or whose payload is not asked for, is
    passed over unread (in a compressed file: inflated, but not kept). The payload of an HTTP record is
    what follows its HTTP headers.
    """
    while (headers := _headers(stream, path)) is not None:
        values: dict[str, object] = {c: headers.get(h) for c, h in _HEADERS.items()}
        length = values["payload_length"]
        values["payload_length"] = int(length) if length and length.isdigit() else None
        for name in ("record_id", "refers_to"):
            if values[name]:
                values[name] = values[name].strip("<>")
        try:
            size = int(headers["content-length"])
        except (KeyError, ValueError):
            raise ValueError(f"{path}: a record without a valid Content-Length") from None
        if not wanted(values) or not payload:
            _skip(stream, size)
            if wanted(values):
                yield values, None
            continue
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{path}: it ends within a record")
        if (values["content_type"] or "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        yield values, block


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, compression: str, rollover: int):
        if compression not in ("none", "gzip"):
            raise ValueError(f"unknown compression: {compression}")
        self.path = path
        self.compression = compression
        self.rollover = rollover

    def _record(self, row: dict) -> bytes:
        block = _HTTP + (row.get("payload") or b"")
        lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Date: {_DATE}"]
        lines.append(f"WARC-Record-ID: <{row['record_id']}>")
        if row.get("target_uri") is not None:
            lines.append("WARC-Target-URI: " + _uri(row["target_uri"]))
        if row.get("refers_to") is not None:
            lines.append(f"WARC-Refers-To: <{row['refers_to']}>")
            lines.append(
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            )
        if row.get("payload_digest") is not None:
            lines.append(f"WARC-Payload-Digest: {row['payload_digest']}")
        if row.get("payload_length") is not None:
            lines.append(f"X-Payload-Length: {row['payload_length']}")
        lines.append("Content-Type: application/http; msgtype=response")
        lines.append(f"Content-Length: {len(block)}")
        whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        return gzip.compress(whole, 6, mtime=0) if self.compression == "gzip" else whole

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = _place(self.path)
        system.create_dir(root, recursive=True)
        ending = ".warc.gz" if self.compression == "gzip" else ".warc"
        paths: list[str] = []
        out = None
        size = 0
        try:
            for piece in all_pieces(batches, "payload"):
                for row in piece.to_pylist():
                    if out is None:
                        paths.append(f"{root.rstrip('/')}/{uuid.uuid4().hex}{ending}")
                        out, size = system.open_output_stream(paths[-1] + ".open", compression=None), 0
                    data = self._record(row)
                    out.write(data)
                    size += len(data)
                    if size >= self.rollover:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(paths)

    def commit(self, messages: list[Written | None]) -> None:
        """Give the files of the tasks that count the names that readers see."""
        system, _ = _place(self.path)
        for message in messages:
            for path in message.paths if message else ():
                system.move(path + ".open", path)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = _place(self.path)
        for message in messages:
            for path in message.paths if message else ():
                system.delete_file(path + ".open")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Records of all archives below `path`. Leave `payload` out of `columns` and it is never read.

    Read anew for each filter: Spark 4.1 keeps the predicates that it has handed to a loaded
    Python source, so a table that was filtered once stays filtered.
    """
    register(spark)
    return spark.read.format("warc").schema(columns).load(path)


def write_warc(table: DataFrame, path: str, **options: str) -> None:
    """Append records (columns of `SCHEMA`) as archives below `path`."""
    register(table.sparkSession)
    names = [f.name for f in T.StructType.fromDDL(SCHEMA).fields]
    shaped = table.select(
        *(F.col(n) if n in table.columns else F.lit(None).cast("string").alias(n) for n in names)
    )
    shaped.write.format("warc").mode("append").options(**options).save(path)


def page_records(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """A record for each row of `pages` (`page_id, url, html`).

    Of rows with equal payloads of `smallest` bytes or more, the one with the smallest page id (null is
    the largest; of rows that share it, the first as read) is a response and the others are revisits of it;
    all smaller ones are responses. Null html is an empty payload; an empty table gives no records.
    """
    pages = settled(pages)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row_id"),
        pages["page_id"].alias("page_id"),
        pages["url"].alias("url"),
        F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8").alias("payload"),
    )
    narrow = stored(
        rows.select(
            "row_id",
            "page_id",
            F.sha2("payload", 256).alias("digest"),
            F.octet_length("payload").cast("long").alias("length"),
        ),
        "digests",
    )
    # Counted before they are joined: a payload of a third of all pages is one row here.
    copied = (
        narrow.where(F.col("length") >= smallest)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
        .where("n > 1")
    )
    copies = stored(narrow.join(copied, "digest").select("digest", "row_id", "page_id", "first"), "copies")
    kept = (
        copies.where(F.col("page_id").eqNullSafe(F.col("first")))
        .groupBy("digest")
        .agg(F.min("row_id").alias("kept"))
    )
    revisits = (
        copies.join(kept, "digest").where("row_id <> kept").select("row_id", "first", "kept")
    )
    name = lambda page, row: F.concat(
        F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string")
    )
    marked = rows.join(stored(revisits, "revisits"), "row_id", "left")
    again = F.col("kept").isNotNull()
    return marked.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page_id"), F.col("row_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(again, name(F.col("first"), F.col("kept"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.sha2("payload", 256)).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_of(record_id) -> F.Column:
    """The page id in a record id that `page_records` made; null if the page had none."""
    part = F.split_part(record_id, F.lit(":"), F.lit(3))
    return F.when(part != "", part).cast("long")
