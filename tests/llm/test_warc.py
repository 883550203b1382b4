import base64
import gzip
import hashlib
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from storelens.llm import warc
from storelens.llm.scratch import new_folder

from tests.llm.tools import table_rows

SCHEMA = "page_id long, url string, html string, digest string"


def brute(pages, min_bytes=0):
    ids = defaultdict(list)
    for i, _, html in pages:
        ids[(html or "").encode()].append(i)
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        keeper = max((x for x in ids[payload] if x is not None), default=None)
        revisit = keeper is not None and i != keeper and len(payload) >= min_bytes
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


PAGES = [
    (1, "http://a/ b\r\nX: y", "same"), (9, "http://a", "same"), (5, None, "same"), (2, "", None), (3, "u", ""),
    (4, "u", "ü" * 400_000), (6, "u", "\r\n\r\nWARC/1.1\r\n\x00"), (None, "u", "same"), (None, "u", "alone"), (None, "u", "alone"),
    (7, "u", "twice"), (7, "u", "twice"), (7, "u", "other"), (8, "u", "other"), (10, "é", "x"), (-3, "u", "x"),
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip_of_odd_pages(spark, min_bytes):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], SCHEMA)
    manifest = warc.write_warc(pages, new_folder(spark, "warc"), min_bytes, roll_bytes=700, part_bytes=100_000)
    assert rows(warc.read_warc(manifest)) == brute(PAGES, min_bytes)
    got = warc.read_warc(manifest, payloads=True).filter("record_type = 'response'").collect()
    want = defaultdict(list)
    for (i, _, html), (_, _, _, kind, _) in zip(sorted(PAGES, key=repr), sorted(brute(PAGES, min_bytes), key=repr)):
        want[i].append(html or "")
    assert all(bytes(r.payload).decode() in want[r.page_id] for r in got)


def test_shards_are_the_same_each_time(spark):
    """Many shards, and other partitions of the input and of its shuffles each time."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = []
    for partitions in (1, 3, 7):
        folder = new_folder(spark, "warc")
        spark.conf.set("spark.sql.shuffle.partitions", str(4 + partitions))
        try:
            made = warc.write_warc(pages.repartition(partitions, "url"), folder, roll_bytes=100_000, part_bytes=300_000)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        manifest = made.collect()
        found.append(sorted((os.path.basename(m.shard), m.records, m.bytes, m.sha256, m.first_id, m.last_id) for m in manifest))
        for m in manifest:
            path = m.shard.removeprefix("file:")
            data = open(path, "rb").read()
            assert hashlib.sha256(data).hexdigest() == m.sha256 and len(data) == m.bytes <= 100_000 or m.records == 1
            assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == m.records + 1
        left = set(os.listdir(folder.removeprefix("file:")))
        assert left == {os.path.basename(m.shard) for m in manifest} | {"_manifest"}
    assert found[0] == found[1] == found[2] and len(found[0]) >= 40
    firsts = [f[4] for f in found[0]]
    assert firsts == sorted(firsts)


def test_ranges_begin_where_the_running_sum_says(spark):
    rows = [(i * 3, (i * 7919) % 50) for i in range(500)] + [(30, 1000), (30, 5)]
    got = warc.range_cuts(spark.createDataFrame(rows, "page_id long, bytes long").repartition(6), 700)
    sums = {}
    for i, n in rows:
        sums[i] = sums.get(i, 0) + n
    want, before, last = [], 0, 0
    for i in sorted(sums):
        if before // 700 > last:
            want.append(i)
        last, before = before // 700, before + sums[i]
    assert got == want and len(want) > 10


def test_query_agrees_with_sql(spark, sf_dir):
    from check import compare, connect

    assert compare(spark, connect(sf_dir), sf_dir, "op9_warc") == ""


def test_damage_is_found(spark, tmp_path):
    member = gzip.decompress(warc.page_record(1, "u", b"payload", None, 0))
    assert warc.parse(member)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(member.replace(b"payload\r\n", b"paylo4d\r\n"))


def test_empty_table(spark):
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), new_folder(spark, "warc"))
    assert manifest.collect() == [] and warc.read_warc(manifest).collect() == []


def test_query_on_table(spark, sf_dir):
    assert rows(warc.op9_warc(spark, sf_dir)) == brute(table_rows(sf_dir, "pages", "page_id, url, html"))
