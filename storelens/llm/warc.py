"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page id.  The borders of the ranges come from exact running
sums of the payloads' sizes, not from a sample, and each range becomes shards that are
rolled by their compressed size.  A shard is written under a temporary name and renamed
when it is whole.  Names and contents depend on the records alone: a repeated task replaces
a shard by the same bytes, and the same table gives the same shards however it is cut into
partitions.  A shard counts only if the manifest lists it, which Spark commits at the end.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.scratch import drop, new_folder, stored

DATE = "2020-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of URLs
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
MANIFEST = "shard string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
READ = 1 << 20
MOST_RANGES = 100_000


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def base32_sha1(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def record_id(page_id: int | None, digest: str, number: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id} {digest} {number}')}>"


def _printable(value: str) -> str:
    """Control characters and white space cannot stand in a header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time stamp
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, number: int) -> bytes:
    """A response, or a revisit of the response of page ``refers_to`` without the payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, number)), ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    headers += [("WARC-Target-URI", _printable(url))] if url else []
    headers += [("X-Page-Id", str(page_id))] if page_id is not None else []
    if refers_to is None:
        return _record(headers, http + payload)
    return _record([
        *headers, ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest)),
        ("X-Refers-To-Page-Id", str(refers_to)),
    ], http)


class _Shards:
    """Shards of ranges of records, written one after the other."""

    def __init__(self, folder: str, roll_bytes: int):
        self.system, self.folder = _filesystem(folder)
        self.uri, self.roll_bytes = folder, roll_bytes
        self.attempt = TaskContext.get().taskAttemptId()
        self.part, self.number = -1, 0
        self.done: list[dict] = []
        self.out = None

    def _open(self) -> None:
        self.name = f"part-{self.part:06d}-{self.number:05d}.warc.gz"
        self.temporary = f"{self.folder}/_temporary-{self.attempt}-{self.name}"
        self.out = self.system.open_output_stream(self.temporary, compression=None)
        self.hash, self.bytes, self.ids = hashlib.sha256(), 0, []
        self.records = 0
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", DATE),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self._write(_record(info, b"format: WARC File Format 1.1\r\n"))

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.bytes += len(member)

    def begin(self, part: int) -> None:
        """From now on shards of another range."""
        self.close()
        self.part, self.number = part, 0

    def add(self, page_id: int | None, member: bytes) -> None:
        if self.out is not None and self.records and self.bytes + len(member) > self.roll_bytes:
            self.close()
        if self.out is None:
            self._open()
        self._write(member)
        self.records += 1
        self.ids = [self.ids[0] if self.ids else page_id, page_id]

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.system.move(self.temporary, f"{self.folder}/{self.name}")
        self.done.append({
            "shard": f"{self.uri}/{self.name}", "records": self.records, "bytes": self.bytes,
            "sha256": self.hash.hexdigest(), "first_id": self.ids[0], "last_id": self.ids[1],
        })
        self.out, self.number = None, self.number + 1


def range_cuts(sizes: DataFrame, part_bytes: int) -> list[int]:
    """The first ``page_id`` of every range but the first: ranges begin where the running sum
    of ``bytes`` in order of id passes another ``part_bytes``.

    The sum runs over sorted partitions; their own sums, a row each, are added up.  No more
    than :data:`MOST_RANGES` numbers come back, as the caller sees to.
    """
    spark = sizes.sparkSession
    path = new_folder(spark, "warc-sizes")
    per_id = sizes.groupBy("page_id").agg(F.sum("bytes").alias("bytes"))
    placed = stored(per_id.orderBy("page_id").withColumn("_place", F.monotonically_increasing_id()), path)
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    totals = placed.groupBy("_part").agg(F.sum("bytes").alias("_total"))
    starts = totals.select("_part", (F.sum("_total").over(Window.orderBy("_part")) - F.col("_total")).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    ranges = placed.join(F.broadcast(starts), "_part").select("page_id", F.floor(before / part_bytes).alias("_range"))
    firsts = ranges.groupBy("_range").agg(F.min("page_id").alias("first")).orderBy("first").collect()
    drop(spark, path)
    return [r["first"] for r in firsts[1:]]


def _range_of(cuts: list[int]):
    """The number of the range of an id."""
    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        firsts = np.array(cuts, dtype=np.int64)
        for ids in batches:
            yield pd.Series(np.searchsorted(firsts, ids.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    return run


def write_warc(
    pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = 64 << 20, part_bytes: int = 16 << 20
) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) under ``folder``
    and return the manifest: shard, records, bytes, SHA-256, first and last id.

    The payload is ``html`` in UTF-8, empty for null.  Of rows with equal payloads of at
    least ``min_bytes`` bytes, that with the largest id is a response and the others
    revisit it; rows that share the largest id are responses, and so are all rows of a
    payload without any id.  Shards hold at most ``roll_bytes`` compressed bytes, or one
    record.  Ranges of ids hold some ``part_bytes`` of payload, the rows of one id always
    together.  Null ids come first; a null or empty url has no header; control characters
    and white space in urls are percent-encoded.  Repeated rows are records each.  An
    empty table makes no shard.  Other columns are not looked at.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # Which pages are revisits is worked out on ids and digests alone, and travels as
    # rows of its own that sort just before the page: the payloads move once.
    slim = rows.filter(F.col("size") >= min_bytes).select("page_id", "digest")
    kept = slim.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter(
        "n > 1 AND keeper IS NOT NULL"
    )
    revisits = slim.join(kept, "digest").filter("page_id IS NULL OR page_id < keeper").select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest",
        F.col("keeper").alias("refers_to"), F.lit(0).alias("kind"),
    ).distinct()
    records = rows.select("page_id", "url", "payload", "digest", F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    part_bytes = max(part_bytes, -(-total // MOST_RANGES))
    cuts = range_cuts(rows.filter("page_id IS NOT NULL").select("page_id", F.col("size").alias("bytes")), part_bytes)
    # rows without an id come first, as the least number does
    part = _range_of(cuts)(F.coalesce("page_id", F.lit(-(2**63))))
    ordered = records.unionByName(revisits).withColumn("part", part).repartition(len(cuts) + 1, "part").sortWithinPartitions(
        "part", F.col("page_id").asc_nulls_first(), "kind", "digest", "url"
    ).select("part", F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest",
             F.col("refers_to").cast("string").alias("refers_to"), "kind")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards = _Shards(folder, roll_bytes)
        page, known, number = object(), {}, {}
        for batch in batches:
            for part, raw_id, url, content, digest, target, kind in batch.itertuples(index=False, name=None):
                if part != shards.part:
                    shards.begin(part)
                page_id = None if pd.isna(raw_id) else int(raw_id)
                if page_id != page:
                    page, known, number = page_id, {}, {}
                if kind == 0:
                    known[digest] = int(target)
                    continue
                url = None if pd.isna(url) else url
                shards.add(page_id, page_record(page_id, url, content, known.get(digest), number.get(digest, 0)))
                number[digest] = number.get(digest, 0) + 1
        shards.close()
        if shards.done:
            done = pd.DataFrame(shards.done)
            yield done.astype({"first_id": "Int64", "last_id": "Int64"})

    system, at = _filesystem(folder)
    system.create_dir(at, recursive=True)
    manifest = stored(ordered.mapInPandas(write, MANIFEST), f"{folder}/_manifest")
    for left in system.get_file_info(fs.FileSelector(at)):  # what lost tasks began
        if left.base_name.startswith("_temporary-"):
            system.delete_file(left.path)
    return manifest


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one at a time."""
    packer, out, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(READ)):
        out.append(packer.decompress(data))
        data = b""
        if packer.eof:
            yield b"".join(out)
            data, packer, out = packer.unused_data, zlib.decompressobj(31), []


def parse(member: bytes) -> dict | None:
    """The columns of a page's record, or None for other records; wrong digests raise."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    if headers["WARC-Type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    return {
        "page_id": headers.get("X-Page-Id"), "url": headers.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": headers["WARC-Type"],
        "refers_to": headers.get("X-Refers-To-Page-Id"), "payload": payload,
    }


def read_warc(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row per response and revisit of the shards that ``manifest`` lists, checked
    against their digests; with ``payloads`` the response's payload as well."""
    names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payloads

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["shard"]:
                system, at = _filesystem(shard)
                held, size = [], 0
                with system.open_input_stream(at, compression=None) as stream:
                    for member in members(stream):
                        if (row := parse(member)) is None:
                            continue
                        held.append([row[c] for c in names])
                        size += len(member) if payloads else 200
                        if size > READ:
                            yield pd.DataFrame(held, columns=names)
                            held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=names)

    # ids come back as text, so that null ids do not turn a column into floats
    plain = RECORD.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    shards = max(1, manifest.count())
    rows = manifest.select("shard").repartition(shards).mapInPandas(read, plain + ", payload binary" * payloads)
    return rows.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    manifest = write_warc(pages, new_folder(spark, "warc"), min_bytes=0)
    return read_warc(manifest).drop("url")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: the digits
OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS digest,
        max(page_id) OVER (PARTITION BY sha1(h)) AS keeper FROM p),
f AS (SELECT *, [CAST('0x' || digest[5 * i + 1 : 5 * i + 5] AS BIGINT) FOR i IN range(8)] AS fives,
        coalesce(page_id < keeper, keeper IS NOT NULL) AS again FROM d)
SELECT page_id, payload_bytes,
    array_to_string([array_to_string([('{_BASE32}')[((x >> s) & 31) + 1] FOR s IN [15, 10, 5, 0]], '') FOR x IN fives], '')
        AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keeper END AS refers_to
FROM f
"""
