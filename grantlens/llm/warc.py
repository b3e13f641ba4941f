"""A deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, hash60, integral

#: A file is closed by the first record that would take it beyond ROLL_BYTES of compressed size.  A range of records has
#: about RANGE_BYTES of text: one task's work, which compresses to about one file.
ROLL_BYTES, RANGE_BYTES = 32 << 20, 128 << 20
#: Keys for each range from which ranges are cut; of all ranges together, as long as each has two.
SAMPLES, ALL_SAMPLES = 32, 4_000_000
DATE = "2020-01-01T00:00:00Z"  # capture date where none is known: one that does not depend on the run
SOFTWARE = "grantlens"


def sort_key(url: Column) -> Column:
    """The address with its host reversed (com,example,www)/path: pages of a host, and hosts of a domain, lie together."""
    address = F.coalesce(url.cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rest = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)).otherwise(address)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(head: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without time or name: the same bytes each time."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    raw = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def response(url: str | None, row_id: int | None, html: str | None, date: str = DATE) -> tuple[bytes, str]:
    """(record, payload digest) with regenerated HTTP and WARC headers; the record's id follows from its content."""
    payload = (html or "").encode()
    target = url if url else f"urn:row:{row_id}"
    target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in target)
    exact = [] if url is None or url == target else [("X-Row-URL", base64.b64encode(url.encode()).decode())]  # an address that is no legal target
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    digest = _digest(payload)
    name = uuid.UUID(bytes=hashlib.md5(f"{target}\n{row_id}\n{digest}".encode()).digest(), version=4)
    head = [
        ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _digest(block)),
        ("X-Row-ID", "" if row_id is None else str(row_id)), ("X-Row-Nulls", ("u" if url is None else "") + ("h" if html is None else "")), *exact, ("Content-Type", "application/http; msgtype=response"),
    ]
    return member(head, block), digest


def info(name: str, date: str = DATE) -> bytes:
    block = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
    made = uuid.UUID(bytes=hashlib.md5(name.encode()).digest(), version=4)
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{made}>"), ("WARC-Date", date), ("WARC-Filename", name), ("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/warc-fields")]
    return member(head, block)


def _bounds(keys: DataFrame, range_bytes: int) -> list[str]:
    """Keys that cut the table into ranges of about equal bytes: quantiles of a sample chosen by hash, the same each time.

    The driver gets SAMPLES keys for each range, or ALL_SAMPLES in all where that is less, but two for each range.
    """
    n, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(1, -(-size // range_bytes))
    if ranges == 1:
        return []
    part = min(1.0, max(2 * ranges, min(ranges * SAMPLES, ALL_SAMPLES)) / n)
    got = keys.filter(F.col("h") < int(part * (1 << 60))).select("key", "size").toArrow()
    rows = sorted(zip((x.encode() for x in got.column("key").to_pylist()), got.column("size").to_pylist()))
    total, seen, out = sum(x for _, x in rows), 0, []
    for key, x in rows:
        if seen * ranges >= total * (len(out) + 1):
            out.append(key)
        seen += x
    return [x.decode() for x in sorted(set(out))]


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = ROLL_BYTES, range_bytes: int = RANGE_BYTES, date: str = DATE,
) -> DataFrame:
    """Writes ``pages`` to ``path`` and returns (file, offset, length, id, url, payload_digest), the index of its records.

    Records are sorted by (reversed host and path, id, hash of the html) across all files ``part-<range>-<number>.warc.gz``;
    ranges are cut by that whole key, so that one address's many rows are not one task's.  They are compressed before they
    are moved, so that a range is cut into files by exact compressed size.  A task writes under a temporary name of its
    own and renames each finished file; the same input gives the same bytes, so a repeated task only replaces a file by
    its equal.  The manifest (index, then ``_MANIFEST.json`` with each file's size, records and SHA-256) is renamed last:
    without it a reader sees nothing.  What failed tasks left under temporary names is deleted then.

    NULL ids, addresses and texts and empty ones are written and read back as such; an address that is no legal target is
    kept in a header of its own; repeated rows are all written; an empty table gives no files and an empty manifest.  Other
    columns are not stored.  One record larger than ``roll_bytes`` has a file of its own.  Ids must be integers (ValueError).
    """
    spark = pages.sparkSession
    one = pages.select(integral(pages, id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    number = F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")  # sorts as the id does
    key = F.concat(sort_key(F.col("url")), F.lit("\0"), F.coalesce(number, F.lit("")), F.lit("\0"), F.md5(F.coalesce("html", F.lit("")))).alias("key")
    sized = one.select(key, (F.coalesce(F.octet_length("html"), F.lit(0)) + 400).cast("bigint").alias("size"), hash60(F.concat_ws("\x1f", F.col("id").cast("string"), "url", F.md5("html"))).alias("h"))
    bounds = _bounds(sized, range_bytes)
    edges = [x.encode() for x in bounds]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                shard, blobs, digests = [], [], []
                for key, row_id, url, html in zip(*(part.column(c).to_pylist() for c in ("key", "id", "url", "html"))):
                    blob, digest = response(url, row_id, html, date)
                    shard.append(bisect.bisect_right(edges, key.encode())), blobs.append(blob), digests.append(digest)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), part.column("key"), part.column("id"), part.column("url"), pa.array(digests), pa.array(blobs, pa.binary())], ["shard", "key", "id", "url", "payload_digest", "record"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        attempt = uuid.uuid4().hex
        out, rows = None, []

        def close() -> pa.RecordBatch:
            nonlocal out, rows
            out["to"].close()
            fs.move(out["tmp"], f"{root}/{out['name']}")
            n = len(rows)
            cols = list(zip(*rows))
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array([out["name"]] * n), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))),
                    pa.array([out["size"]] * n, pa.int64()), pa.array([out["sha"].hexdigest()] * n),
                ], ["file", "offset", "length", "id", "url", "payload_digest", "file_bytes", "file_sha256"],
            )
            out, rows = None, []
            return made

        now, number = None, 0
        for batch in batches:
            for shard, row_id, url, digest, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "id", "url", "payload_digest", "record"))):
                if out and (shard != now or out["size"] + len(blob) > roll_bytes):
                    yield close()
                number = 0 if shard != now else number
                now = shard
                if not out:
                    name = f"part-{shard:05d}-{number:05d}.warc.gz"
                    number += 1
                    out = {"name": name, "tmp": f"{root}/_tmp-{attempt}-{name}", "sha": hashlib.sha256(), "size": 0}
                    out["to"] = fs.open_output_stream(out["tmp"], compression=None)
                    head = info(name, date)
                    out["to"].write(head), out["sha"].update(head)
                    out["size"] = len(head)
                rows.append((out["size"], len(blob), row_id, url, digest))
                out["to"].write(blob), out["sha"].update(blob)
                out["size"] += len(blob)
        if out:
            yield close()

    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    keyed = one.select(key, "id", "url", "html")
    records = keyed.mapInArrow(make, "shard int, key string, id bigint, url string, payload_digest string, record binary")
    together = records.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "key", "record")
    written = together.mapInArrow(write, "file string, offset bigint, length bigint, id bigint, url string, payload_digest string, file_bytes bigint, file_sha256 string")
    staged, final = f"{path}/_tmp-index-{uuid.uuid4().hex}", f"{path}/_index"
    written.write.parquet(staged)
    _rename(spark, staged, final)
    index = spark.read.schema(written.schema).parquet(final)
    files = index.groupBy("file").agg(F.count("*").alias("records"), F.first("file_bytes").alias("bytes"), F.first("file_sha256").alias("sha256")).orderBy("file").toArrow().to_pylist()  # a row for each file
    with fs.open_output_stream(f"{root}/_tmp-manifest", compression=None) as f:
        f.write(json.dumps({"files": files}, indent=1).encode())
    fs.move(f"{root}/_tmp-manifest", f"{root}/_MANIFEST.json")
    for left in fs.get_file_info(pafs.FileSelector(root)):
        if left.base_name.startswith("_tmp-"):
            fs.delete_file(left.path) if left.is_file else fs.delete_dir(left.path)
    return index.select("file", "offset", "length", "id", "url", "payload_digest").withColumnRenamed("id", id_col)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"{old} could not be renamed to {new}")


def parse_members(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a file, which is read piece by piece."""
    data = b""
    while data := data or file.read(1 << 18):
        z, raw = zlib.decompressobj(31), []
        while not z.eof:
            if not data and not (data := file.read(1 << 18)):
                raise ValueError("the file ends within a record")
            raw.append(z.decompress(data))
            data = z.unused_data
        head, _, rest = b"".join(raw).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html, payload_digest) of the records of the files in the manifest, checked against their digests."""
    fs, root = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{root}/_MANIFEST.json", compression=None) as f:
        files = [x["file"] for x in json.loads(f.read())["files"]]
    names = spark.createDataFrame([(x,) for x in files], "file string").repartition(max(1, len(files)))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(), pa.string()))], ["page_id", "url", "html", "payload_digest"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out: list[tuple] = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for head, block in parse_members(f):
                        if _digest(block) != head["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: a record differs from its digest")
                        if head["WARC-Type"] != "response":
                            continue
                        payload, nulls = block.partition(b"\r\n\r\n")[2], head["X-Row-Nulls"]
                        url = base64.b64decode(head["X-Row-URL"]).decode() if "X-Row-URL" in head else head["WARC-Target-URI"]
                        out.append((int(head["X-Row-ID"]) if head["X-Row-ID"] else None, None if "u" in nulls else url, None if "h" in nulls else payload.decode(), head["WARC-Payload-Digest"]))
                        if len(out) == 512:
                            yield batch_of(out)
                            out = []
                if out:
                    yield batch_of(out)

    return names.mapInArrow(read, "page_id bigint, url string, html string, payload_digest string")


def export_pages(pages: DataFrame) -> DataFrame:
    """:func:`write_warc` into a new folder of the shared folder."""
    return write_warc(pages, fresh_path(pages.sparkSession, "warc"))
