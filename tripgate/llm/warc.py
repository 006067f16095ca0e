"""WARC archives of a page table, written and read as a chunked record table.

A payload never travels whole through Python: it is cut into rows (record, chunk number) of at most
``CHUNK`` bytes, in order, and digests are carried along from chunk to chunk. Writers turn a
partition's chunk rows into gzip members of a WARC/1.1 file as they come, readers turn an
archive back into chunk rows with the digest so far; a record's last chunk has its full size and digest.

Archives are written under a name of the task attempt in a shared folder, through the folder's own
file system; only the files that the committed manifest names count, so lost and repeated attempts do no harm.

Payloads of at least ``least_bytes`` that are equal are stored once, as the response of the row with
the largest id (of equal ids the row furthest into the table); the others become revisits of it.
Defined cases: a null payload is empty; a null or odd url is replaced or percent-encoded;
null ids are written without an id and are the smallest; repeated rows are records each; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, ship, small
from tripgate.session import scratch_dir

CHUNK = 64 << 10
ARCHIVE_BYTES = 1 << 30
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_ROWS = 512
_BYTES = 4 << 20


def chunked(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of (the columns but ``payload``, n_bytes, chunk_no, n_chunks, chunk); an empty payload is one empty chunk."""
    rest = [c for c in pages.columns if c != "payload"]
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    last = F.greatest(F.ceil(size / chunk).cast("int") - 1, F.lit(0))
    return (pages.select(*rest, "payload", size.cast("long").alias("n_bytes"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"), (last + 1).alias("n_chunks"))
            .withColumn("chunk", F.coalesce(F.substr("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)), F.lit(b"")))
            .drop("payload"))


def identified(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    """(rid, id, url, payload), written once: ``rid`` numbers the rows, and every later pass finds the same numbers,
    whatever executors and splits it gets."""
    return materialize(pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_column).cast("string"), F.lit("")), "UTF-8").alias("payload")), "warc-rows")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def digests(chunks: DataFrame) -> DataFrame:
    """(rid, id, n_bytes, digest) from chunk rows, which come in order; the digest is carried from chunk to chunk."""

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha1()
        for b in batches:
            out = [], [], [], []
            for rid, key, size, no, n, chunk in zip(*(b.column(c) for c in ("rid", "id", "n_bytes", "chunk_no", "n_chunks", "chunk")), strict=True):
                if no.as_py() == 0:
                    sha = hashlib.sha1()
                sha.update(chunk.as_buffer())
                if no.as_py() + 1 == n.as_py():
                    for column, value in zip(out, (rid.as_py(), key.as_py(), size.as_py(), base32(sha.digest())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                                             ["rid", "id", "n_bytes", "digest"])

    return chunks.select("rid", "id", "n_bytes", "chunk_no", "n_chunks", "chunk").mapInArrow(carried, "rid long, id long, n_bytes long, digest string")


def _record_id(rid: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'row:{rid}')}>"


def _head(kind: str, rid: int, key: int | None, url: str | None, size: int, digest: str, to_rid: int | None, to_id: int | None) -> bytes:
    """WARC and HTTP headers of a record; the payload follows a response's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(rid)}", f"WARC-Date: {DATE}",
             "WARC-Target-URI: " + (quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:x-row:{rid}"),
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + (size if kind == 'response' else 0)}", f"X-Payload-Length: {size}"]
    if key is not None:
        lines.append(f"X-Row-Id: {key}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(to_rid)}"]
        if to_id is not None:
            lines.append(f"X-Refers-To-Row-Id: {to_id}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the path in it."""
    scheme, colon, rest = folder.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else scheme).lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
                   least_bytes: int = 0, chunk: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives into ``folder`` and returns their manifest (path, records, bytes)."""
    spark = pages.sparkSession
    ship(spark)
    rows = identified(pages, id_column, url_column, payload_column)
    known = materialize(digests(chunked(rows.drop("url"), chunk)), "warc-digests")
    groups = (known.where(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes")
              .agg(F.max(F.struct("id", "rid")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("digest", "n_bytes", F.col("top.id").alias("to_id"), F.col("top.rid").alias("to_rid")))
    revisits = materialize(known.join(groups, ["digest", "n_bytes"]).where("rid <> to_rid").select("rid", "to_rid", "to_id"), "warc-revisits")
    joined = rows.join(small(revisits, revisits.count(), 40), "rid", "left").withColumn("kind", F.when(F.col("to_rid").isNull(), "response").otherwise("revisit"))
    # the digest goes into the header, before the payload; a revisit has no payload
    joined = joined.select("rid", "id", "url", "to_rid", "to_id", "kind", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"),
                           F.when(F.col("kind") == "response", F.col("payload")).alias("payload"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, base = _store(folder)
        system.create_dir(base, recursive=True)
        name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        out, path, done, records, squeeze, number = None, "", 0, 0, None, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": records, "bytes": done}], schema=pa.schema(
                [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for b in batches:
            for r in zip(*(b.column(c) for c in ("rid", "id", "url", "to_rid", "to_id", "kind", "sha", "size", "chunk_no", "n_chunks", "chunk")), strict=True):
                rid, key, url, to_rid, to_id, kind, sha, size, no, n = (x.as_py() for x in r[:10])
                if no == 0:
                    if out is not None and done >= archive_bytes:
                        yield closed()
                        out = None
                    if out is None:
                        path = f"{base}/{name}-{number:04d}.warc.gz"
                        out, done, records, number = system.open_output_stream(path, compression=None), 0, 0, number + 1
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    records += 1
                    piece = squeeze.compress(_head(kind, rid, key, url, size, base32(bytes.fromhex(sha)), to_rid, to_id))
                    out.write(piece)
                    done += len(piece)
                piece = squeeze.compress(r[10].as_buffer())
                if no + 1 == n:
                    piece += squeeze.compress(b"\r\n\r\n") + squeeze.flush()
                out.write(piece)
                done += len(piece)
        if out is not None:
            yield closed()

    return materialize(chunked(joined, chunk).mapInArrow(written, "path string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Bytes of a gzip file with many members, in bounded pieces."""

    def __init__(self, source):
        self.source, self.member, self.raw, self.held = source, None, b"", bytearray()

    def more(self) -> bool:
        """Adds some bytes; false at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    if self.member is not None and not self.member.eof:
                        raise ValueError("the archive ends inside a record")
                    return False
            if self.member is None or self.member.eof:
                self.member = zlib.decompressobj(31)
            got = self.member.decompress(self.raw, CHUNK)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if len(self.held) > 1 << 20:
                raise ValueError("a header is longer than a megabyte")
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a header")
                return None
        out = bytes(self.held[:end + len(mark)])
        del self.held[:end + len(mark)]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """n bytes in pieces of at most CHUNK."""
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends inside a payload")
            piece = bytes(self.held[:min(n, CHUNK)])
            del self.held[:len(piece)]
            n -= len(piece)
            yield piece


def _headers(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:]) if k}


def _records(stream: _Stream) -> Iterator[tuple]:
    """(header, chunk number, chunk, bytes so far, SHA-1 so far, last) of each chunk of each record."""
    while (block := stream.until(b"\r\n\r\n")) is not None:
        head = _headers(block)
        length = int(head["content-length"])
        if "http" in head.get("content-type", ""):
            length -= len(stream.until(b"\r\n\r\n"))
        sha, size, no, held = hashlib.sha1(), 0, 0, b""
        for piece in stream.take(length):
            sha.update(piece)
            size += len(piece)
            yield head, no, piece, size, sha, size == length
            no += 1
        if not length:
            yield head, 0, held, 0, sha, True
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError(f"{head.get('warc-record-id')} is not closed")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Chunk rows (record_id, record_type, refers_to_record, id, refers_to, chunk_no, chunk, bytes_so_far, digest_so_far,
    payload_bytes, payload_digest, last) of the archives that a manifest (path, ...) names.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for revisits; a response
    whose bytes disagree with its header raises. ``payloads=False`` leaves ``chunk`` null.
    """
    ship(manifest.sparkSession)
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to_record", pa.string()), ("id", pa.int64()), ("refers_to", pa.int64()),
                        ("chunk_no", pa.int32()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("last", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _store(folder)
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows, size = [], 0
            with system.open_input_stream(path, compression=None) as source:
                for head, no, chunk, so_far, sha, last in _records(_Stream(source)):
                    number = lambda name, head=head: int(head[name]) if name in head else None
                    digest = base32(sha.digest())
                    told = head["warc-payload-digest"].removeprefix("sha1:")
                    kind = head["warc-type"]
                    if last and kind == "response" and (digest, so_far) != (told, number("x-payload-length")):
                        raise ValueError(f"{head['warc-record-id']} has another payload than its header says")
                    rows.append((head["warc-record-id"], kind, head.get("warc-refers-to"), number("x-row-id"), number("x-refers-to-row-id"), no,
                                 chunk if payloads else None, so_far, digest, number("x-payload-length"), told, last))
                    size += len(chunk)
                    if len(rows) >= _ROWS or size >= _BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files, F.xxhash64("path")).mapInArrow(
        read, "record_id string, record_type string, refers_to_record string, id long, refers_to long, chunk_no int, chunk binary, "
        "bytes_so_far long, digest_so_far string, payload_bytes long, payload_digest string, last boolean")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archives of all pages in the shared folder, read back as one row for each record."""
    folder = scratch_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, least_bytes=least_bytes)
    return read_archives(manifest, folder, payloads=False).where("last")
