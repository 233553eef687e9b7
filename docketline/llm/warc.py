"""WARC: write archives, normalise whole-file gzip archives, read them back.

``write_archives`` turns records into WARC files of one gzip stream each (the
usual mistake of plain ``gzip file.warc``: such a file can't be read from the
middle). ``normalise`` inflates each such stream once, front to back, rewrites
every record as a gzip member of its own and writes a sidecar index (``.idx``:
offset, length, type and id of each record) beside the new archive; its rows are
also the result table. ``read_records`` reads records by offset and length.

Memory: archives, records and payloads are passed through in blocks; nothing
holds a whole archive. An archive is closed at ``ARCHIVE_BYTES``, so their number
grows with the data and a task handles bounded files. Files go to the shared
folder through ``pyarrow.fs``, under names unique to the task attempt; only the
names that the written (committed) manifest lists count, so a lost executor or a
repeated task leaves nothing wrong.

Defined results: a null payload is an empty one; a null URI leaves the header
out, control characters in it are percent-encoded; ids may be null or repeated;
empty tables give no archives. A stream that is cut off or no gzip at all gives
the whole records before the fault, and an index row of type 'error' with the
reason; so does a malformed header. A header may be of any length.
``archive_pages`` fails if a record it wrote isn't in the index. Clashing extra columns can't occur: callers
pass the columns by name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize
from docketline.session import ensure_checkpoint_dir

ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 16
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: A fixed date keeps archives the same from run to run.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def record_bytes(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit if ``refers_to`` is given."""
    head = HTTP_HEAD % len(payload)
    block = head if refers_to else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_safe(uri)}")
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def new_folder(df: DataFrame, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _attempt() -> str:
    c = TaskContext.get()
    return f"{c.partitionId():06d}-{c.attemptNumber()}-{c.taskAttemptId()}"


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """records (record_id, uri, payload binary, refers_to) -> manifest rows
    (archive, n_records), one gzip stream a file; lazy, write the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        fs.create_dir(base, recursive=True)
        done, stem, out, count, size = [], _attempt(), None, 0, 0

        def close() -> None:
            out.write(squeeze.flush())
            out.close()
            done.append((f"{folder}/{stem}-{len(done):04d}.warc.gz", count))

        for b in batches:
            for rid, uri, payload, ref in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out = fs.open_output_stream(f"{base}/{stem}-{len(done):04d}.warc.gz", compression=None)
                    count = size = 0
                data = record_bytes(rid, uri, payload or b"", ref)
                for i in range(0, len(data), BLOCK * 16):
                    out.write(squeeze.compress(data[i:i + BLOCK * 16]))
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        names, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["archive", "n_records"])

    cols = [F.coalesce(F.col("record_id").cast("string"), F.lit("")), F.col("uri").cast("string"),
            F.col("payload").cast("binary"), F.col("refers_to").cast("string")]
    return records.select(*cols).mapInArrow(run, "archive string, n_records long")


class Malformed(ValueError):
    pass


class Inflated:
    """The text of a gzip file, however many members it has, read in blocks."""

    def __init__(self, raw):
        self.raw, self.buffer, self.tail, self.z, self.more = raw, bytearray(), b"", zlib.decompressobj(31), True

    def fill(self, n: int) -> bool:
        """Have ``n`` bytes in the buffer, if there are as many."""
        while len(self.buffer) < n and self.more:
            data, self.tail = self.tail or self.raw.read(BLOCK), b""
            if self.z.eof:  # another member may follow, or zeros as padding
                if not data:
                    self.more = False
                elif data := data.lstrip(b"\0"):
                    self.z = zlib.decompressobj(31)
            elif not data:
                raise Malformed("the gzip stream is cut off")
            if data:
                try:
                    self.buffer += self.z.decompress(data, BLOCK * 4)
                except zlib.error as e:
                    raise Malformed(f"not a gzip stream: {e}") from None
                self.tail = self.z.unconsumed_tail or self.z.unused_data
        return len(self.buffer) >= n

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def heads(stream: Inflated) -> Iterator[tuple[bytes, dict[str, str], int]]:
    """(header bytes, fields, block length) of each record; the caller must take
    block and the closing two line ends before asking for the next."""
    while True:
        while stream.fill(2) and stream.buffer[:2] == b"\r\n":
            stream.take(2)
        if not stream.fill(1):
            return
        if not stream.fill(5) or stream.buffer[:5] != b"WARC/":  # so nothing else is searched for a header's end
            raise Malformed("no WARC record header")
        seen = 0
        while (end := stream.buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(stream.buffer)
            if not stream.fill(seen + 1):
                raise Malformed("a record header is cut off")
        head = stream.take(end + 4)
        lines = head[:-4].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not fields.get("content-length", "").isdigit():
            raise Malformed("no WARC record header")
        yield head, fields, int(fields["content-length"])


_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()),
                    ("record_id", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("uri", pa.string()),
                    ("error", pa.string())])
_INDEX_DDL = ("archive string, offset long, length long, record_type string, record_id string, refers_to string, "
              "payload_digest string, uri string, error string")


#: A batch of index rows ends at so many characters of URIs.
_INDEX_CHARS = 4 << 20


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def normalise_file(source: str, target: str) -> Iterator[tuple]:
    """Rewrite one archive and write its sidecar; yields the index rows."""
    fs, path = _place(source)
    out_fs, out_path = _place(target)
    offset = 0
    with fs.open_input_stream(path, compression=None) as raw, out_fs.open_output_stream(out_path, compression=None) as out, \
            out_fs.open_output_stream(out_path + ".idx") as idx:
        stream = Inflated(raw)
        try:
            for head, f, length in heads(stream):
                squeeze, size, left = zlib.compressobj(6, zlib.DEFLATED, 31), 0, length
                parts = [squeeze.compress(head)]
                whole = True
                while left and whole:
                    whole = stream.fill(min(left, BLOCK))
                    if whole:
                        parts.append(squeeze.compress(block := stream.take(min(left, BLOCK))))
                        left -= len(block)
                if not whole:
                    raise Malformed("a record's block is cut off")
                parts.append(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
                for p in parts:  # compressed; written only when the record is whole
                    out.write(p)
                    size += len(p)
                row = (target, offset, size, f.get("warc-type"), _bare(f.get("warc-record-id")), _bare(f.get("warc-refers-to")),
                       (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None, f.get("warc-target-uri"), None)
                idx.write(f"{offset} {size} {row[3]} {row[4]}\n".encode())
                offset += size
                yield row
        except (Malformed, EOFError) as e:
            yield (target, offset, 0, "error", None, None, None, None, str(e))


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """manifest (archive) -> index rows of the rewritten archives in ``folder``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        fs.create_dir(base, recursive=True)
        stem, k = _attempt(), 0
        for b in batches:
            for source in b.column(0).to_pylist():
                rows, held = [], 0
                for row in normalise_file(source, f"{folder}/{stem}-{k:04d}.warc.gz"):
                    rows.append(row)
                    held += len(row[7] or "")
                    if len(rows) == 4096 or held > _INDEX_CHARS:
                        yield _index(rows)
                        rows, held = [], 0
                if rows:
                    yield _index(rows)
                k += 1

    return manifest.select("archive").mapInArrow(run, _INDEX_DDL)


def _index(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)


def read_records(index: DataFrame, fn: Callable[[dict[str, str], bytes], tuple], schema: pa.Schema, ddl: str) -> DataFrame:
    """``fn(fields, payload)`` for each indexed record, read by offset and
    length alone; one record is in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if archive != name:
                    if source is not None:
                        source.close()
                    fs, path = _place(archive)
                    name, source = archive, fs.open_input_file(path)
                data = zlib.decompress(source.read_at(length, offset), 31)
                end = data.index(b"\r\n\r\n") + 4
                lines = data[:end - 4].decode("utf-8", "replace").split("\r\n")
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                block = data[end:end + int(fields["content-length"])]
                http = block.find(b"\r\n\r\n") + 4 if "application/http" in fields.get("content-type", "") else 0
                rows.append(fn(fields, block[http:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if source is not None:
            source.close()

    return index.where(F.col("record_type") != "error").select("archive", "offset", "length").mapInArrow(run, ddl)


def revisits(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """(page_id, payload_sha, refers_to): the pages whose payload another page
    with a larger id has too. Only ids and digests are shuffled; a digest that a
    third of all rows share is summed before the shuffle."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    narrow = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.sha1(payload.cast("binary")).alias("payload_sha"))
    last = (narrow.groupBy("payload_sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & F.col("refers_to").isNotNull()).select(F.col("payload_sha").alias("sha"), "refers_to"))
    joined = narrow.join(last, narrow["payload_sha"] == last["sha"])
    return (joined.where(F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
            .select("page_id", "payload_sha", "refers_to").distinct())


def archive_pages(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                  prefix: str = "urn:page:") -> DataFrame:
    """Write a record a page (equal payloads: the largest id is the response,
    the others revisit it), normalise the archives, and return the index."""
    r = revisits(pages, id_col, payload_col).select(F.col("page_id").alias("r_id"), F.col("payload_sha").alias("r_sha"), "refers_to")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{uri_col}`").cast("string").alias("uri"), payload.alias("payload"))
    marked = p.join(r, p["page_id"].eqNullSafe(r["r_id"]) & (F.sha1(p["payload"]) == r["r_sha"]), "left")
    def name(c: str):
        return F.concat(F.lit(prefix), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    records = marked.select(name("page_id").alias("record_id"), "uri", "payload",
                            F.when(F.col("refers_to").isNotNull(), name("refers_to")).alias("refers_to"))
    manifest = materialize(write_archives(records, new_folder(pages, "warc-whole")), "warc-manifest")
    spread = manifest.repartition(max(1, pages.sparkSession.sparkContext.defaultParallelism, manifest.count()), "archive")
    index = materialize(normalise(spread, new_folder(pages, "warc-members")), "warc-index")
    check_whole(manifest, index)
    return index


def check_whole(manifest: DataFrame, index: DataFrame) -> None:
    """Fail if the index lacks records that the manifest counts."""
    error = F.col("record_type") == "error"
    got = index.agg(F.count_if(error.isNull() | ~error).alias("n"), F.max(F.when(error, F.concat_ws(": ", "archive", "error"))).alias("error")).first()
    written = manifest.agg(F.sum("n_records")).first()[0] or 0
    if got["error"] is not None or got["n"] != written:
        raise Malformed(f"{got['n']} of {written} records were read back; {got['error'] or 'no error row'}")
