"""Operator 5: WARC archives, written one gzip member per record and read back sequentially.

Equal payloads of at least ``least`` bytes are stored once: the record with the largest
id is the response, the others are revisit records that refer to it.  Writers are
Spark tasks; each closes an archive at ``roll`` bytes and reports it, and only reported
archives of tasks that ended well are in the manifest, so that a task that is run again
leaves nothing that a reader would see.

The reader takes one archive of the manifest after the other, in chunks: zlib
decompression is incremental, one member after the other, a record's block is framed
by its Content-Length, and both of its digests are verified.

Defined cases: a null payload is empty; payloads under ``least`` bytes are always
responses; a null id never wins over another id, and a group of null ids alone has no
revisits; repeated rows with the largest id are all responses; a null URL is written as
an URN of the id; an empty table gives no records; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.components import saved
from docketflow.session import new_work_dir

LEAST, ROLL, CHUNK, SALTS = 1000, 64 << 20, 1 << 18, 32
DATE = "2000-01-01T00:00:00Z"  # records carry no time of writing: equal input gives equal archives
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record: a response, or a revisit with the response's HTTP header alone."""
    urn = f"urn:x-page:{'' if page is None else page}"
    target = "".join(c if 0x20 < ord(c) < 0x7F else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else urn
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{urn}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {sha1(payload)}", f"WARC-Block-Digest: {sha1(block)}", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def place(uri: str):
    """File system and path of a shared folder, by Arrow's readers and writers."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, folder: str, id_col: str, url_col: str, html_col: str, least: int = LEAST, roll: int = ROLL) -> DataFrame:
    """Writes every page to archives under ``folder``; the manifest: path, records, bytes."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    src = src.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    again = src.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "top")
    # payloads that many pages share are dealt over the salts; the small side has a row for each
    salted = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = src.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    revisit = (F.col("size") >= least) & F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    rows = known.select("id", "url", "html", F.when(revisit, F.col("top")).alias("refers_to"))

    def write(batches):
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        out, name, n, size = None, None, 0, 0
        for batch in batches:
            for page, url, html, ref in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                data = member(record(page, url, html.encode("utf-8", "surrogatepass"), ref))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": n, "bytes": size}])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": n, "bytes": size}])

    return saved(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def members(stream, chunk: int = CHUNK):
    """The gzip members of a stream, each as the pieces that incremental decompression gives."""
    left = b""
    while True:
        data = left or stream.read(chunk)
        if not data:
            return
        unpress, left = zlib.decompressobj(31), b""

        def pieces(data=data, unpress=unpress):
            nonlocal left
            while True:
                yield unpress.decompress(data)
                if unpress.eof:
                    left = unpress.unused_data
                    return
                data = stream.read(chunk)
                if not data:
                    raise EOFError("an archive ends within a record")

        parts = pieces()
        yield parts
        for _ in parts:
            pass


def parse(parts) -> dict:
    """One record of its member's pieces: header fields, block length and digests checked as the pieces come."""
    buffer = b""
    for piece in parts:
        buffer += piece
        if b"\r\n\r\n" in buffer:
            break
    head, _, buffer = buffer.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("a member doesn't start with a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    need, block, payload, http, n = int(fields["content-length"]), hashlib.sha1(), hashlib.sha1(), b"", 0
    body = False

    def feed(data: bytes) -> None:
        nonlocal http, body, n
        block.update(data)
        if not body:
            http += data
            if b"\r\n\r\n" not in http:
                return
            http, _, data = http.partition(b"\r\n\r\n")
            body = True
        payload.update(data)
        n += len(data)

    feed(buffer[:need])
    got, tail = min(len(buffer), need), buffer[need:]
    for piece in parts:
        feed(piece[: need - got])
        tail += piece[need - got :] if len(piece) > need - got else b""
        got = min(need, got + len(piece))
    if got != need or tail != b"\r\n\r\n":
        raise ValueError("a record's block isn't as long as its Content-Length")
    length = next(int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length")
    code = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
    kind = fields["warc-type"]
    good = code(block) == fields["warc-block-digest"] and (n == 0 if kind == "revisit" else n == length and code(payload) == fields["warc-payload-digest"])
    number = lambda v: v.strip("<>").removeprefix("urn:x-page:") or None if v else None
    return {
        "page": number(fields["warc-record-id"]), "url": fields["warc-target-uri"], "payload_bytes": length, "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "record_type": kind, "refers_to": number(fields.get("warc-refers-to")), "verified": good,
    }


SHAPE = {"page": pa.string(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.string(), "verified": pa.bool_()}


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's archives."""
    schema = pa.schema(list(SHAPE.items()))

    def read(batches):
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, name = place(path)
                with system.open_input_stream(name, compression=None) as stream:
                    found, n = [], 0
                    for parts in members(stream):
                        found.append(parse(parts))
                        n += 1
                        if len(found) == 5000:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found = []
                    if n != records:
                        raise ValueError(f"{path} has {n} records instead of {records}")
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema)

    files = manifest.select("path", "records")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInArrow(read, "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, verified boolean")


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to, verified."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = read_archives(write_archives(pages, new_work_dir(spark, "warc"), "page_id", "url", "html"))
    return found.select(F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"), "verified")


OP5_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as payload_digest from p),
t as (select *, max(page_id) over (partition by payload_digest) as top from d)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> top then top end as refers_to, true as verified from t
"""
