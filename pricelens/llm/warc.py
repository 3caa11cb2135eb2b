"""WARC archives: one gzip member per record, written and read as a stream.

``plan_records`` decides with two narrow passes which pages repeat an earlier
payload; ``write_archives`` lets every task write archives of a bounded size into
a shared folder and returns a manifest, a row per archive; ``read_archives`` reads
the archives of a manifest. A task attempt writes under a name of its own and the
manifest is committed by Spark, so files of lost or repeated attempts are never
read. Neither side holds more than one payload (writer) or one block of bytes
(reader) in memory. Folders are opened with ``pyarrow.fs``, so any store it knows
will do.

Defined cases: a NULL payload is the empty one; a NULL URL leaves the header out;
a NULL id is written as ``null`` and comes back as NULL. Among rows that share the
smallest id of an equal payload, all are responses. NULL ids come last in that
order. Payloads under ``MIN_REVISIT`` bytes are always responses. An empty table
gives an empty manifest. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.files import open_folder
from pricelens.session import scratch_path, stage_table

MIN_REVISIT = 100
ARCHIVE_BYTES = 128 << 20
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
URN = "urn:pricelens:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string"


# --- one record --------------------------------------------------------------


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record_bytes(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A WARC record as one gzip member; a revisit keeps the HTTP head only."""
    block = http_head(len(payload)) + (b"" if refers_to else payload)
    head = {
        "WARC-Type": "revisit" if refers_to else "response",
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": uri and " ".join(uri.split()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Refers-To": refers_to and f"<{refers_to}>",
        "WARC-Profile": refers_to and PROFILE,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v)
    packer = zlib.compressobj(wbits=31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


class MemberReader:
    """Bytes of one gzip member after another, inflated a chunk at a time."""

    def __init__(self, stream, chunk: int = CHUNK):
        self.stream, self.chunk, self.packed = stream, chunk, b""
        self.inflater, self.ready = None, bytearray()

    def next_member(self) -> bool:
        self.packed = self.packed or self.stream.read(self.chunk)
        self.inflater, self.ready = zlib.decompressobj(wbits=31), bytearray()
        return bool(self.packed)

    def _more(self) -> bool:
        if self.inflater.eof:
            return False
        if not self.packed:
            self.packed = self.stream.read(self.chunk)
            if not self.packed:
                raise ValueError("archive ends inside a gzip member")
        self.ready += self.inflater.decompress(self.packed, self.chunk)
        self.packed = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with the mark."""
        while (at := self.ready.find(mark)) < 0:
            if not self._more():
                raise ValueError("record head without an end")
        found = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            while not self.ready:
                if not self._more():
                    raise ValueError("record is shorter than its Content-Length")
            piece = bytes(self.ready[:n])
            del self.ready[:n]
            n -= len(piece)
            yield piece

    def at_end(self) -> bool:
        while not self.ready and self._more():
            pass
        return not self.ready


def head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def read_records(stream, with_payload: bool = False, chunk: int = CHUNK) -> Iterator[dict]:
    """Records of an archive in order, with both digests verified."""
    reader = MemberReader(stream, chunk)
    while reader.next_member():
        head = head_fields(reader.until(b"\r\n\r\n"))
        block, body, size, whole = hashlib.sha256(), hashlib.sha256(), 0, []
        http, rest = b"", int(head["content-length"])
        for piece in reader.exactly(rest):
            block.update(piece)
            if b"\r\n\r\n" not in http:
                http += piece
                if b"\r\n\r\n" not in http:
                    continue
                at = http.index(b"\r\n\r\n") + 4
                http, piece = http[:at], http[at:]
            body.update(piece)
            size += len(piece)
            if with_payload:
                whole.append(piece)
        if b"".join(reader.exactly(4)) != b"\r\n\r\n":
            raise ValueError("record is longer than its Content-Length")
        if not reader.at_end():
            raise ValueError("more than one record in a gzip member")
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        if head["warc-block-digest"] != f"sha256:{block.hexdigest()}":
            raise ValueError(f"block digest differs in {head['warc-record-id']}")
        is_response = head["warc-type"] == "response"
        announced = int(head_fields(http)["content-length"])
        if is_response and (digest != body.hexdigest() or announced != size):
            raise ValueError(f"payload digest differs in {head['warc-record-id']}")
        yield {
            "record_id": head["warc-record-id"].strip("<>"),
            "record_type": head["warc-type"],
            "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to", "").strip("<>") or None,
            "payload_bytes": announced,
            "payload_digest": digest,
        } | ({"payload": b"".join(whole)} if with_payload else {})


# --- tables ------------------------------------------------------------------


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Pages as records: ``id``, ``url``, ``payload``, ``digest``, ``refers`` (or NULL).

    The smallest id of every repeated payload is found with partial sums; the
    join back reads it from a stored table, so a payload that a third of all
    pages share is split by the engine's skew handling.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    records = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    records = records.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    again = (
        records.filter(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min("id").alias("first_id"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    joined = records.join(stage_table(again, "repeated_payloads"), F.col("digest") == F.col("first_digest"), "left")
    repeats = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select("id", "url", "payload", "digest", F.when(repeats, F.col("first_id")).alias("refers"))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows one at a time, so that one payload is held as an object."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records; returns the stored manifest (``archive``, ``records``)."""

    def write(batches):
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        out, name, count, size = None, "", 0, 0
        for batch in batches:
            for row in rows_of(batch):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                refers = None if row["refers"] is None else f"{URN}{row['refers']}"
                own = "null" if row["id"] is None else row["id"]
                packed = record_bytes(f"{URN}{own}", row["url"], row["payload"].encode(), row["digest"], refers)
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [name], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [count]})

    return stage_table(records.mapInArrow(write, "archive string, records long"), "warc_manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the manifest's archives, each read by one task."""

    def read(batches):
        store, base = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{base}/{row['archive']}", compression=None) as stream:
                    found, total = [], 0
                    for record in read_records(stream):
                        found.append(record)
                        if len(found) == 4096:
                            total += len(found)
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found = []
                    total += len(found)
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema)
                if total != row["records"]:
                    raise ValueError(f"{row['archive']} holds {total} records, not {row['records']}")

    schema = pa.schema(
        [(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in (x.split()[0] for x in READ_SCHEMA.split(", "))]
    )
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks).mapInArrow(read, READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a page table to archives and read it back: one row per page."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(plan_records(pages), folder)
    own = F.substring_index("record_id", ":", -1)
    return read_archives(manifest, folder).select(
        F.when(own != "null", own.cast("long")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.substring_index("refers_to", ":", -1).cast("long").alias("refers_to"),
    )
