"""SimHash near-dedup over word shingles.

``simhash_components`` links whole-document fingerprints that differ in a few bits and
``keep_one_per_group`` drops near copies by shingle similarity.  Words and shingles are
hashed in Arrow batches; candidates, links and components are Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.components import components
from storelens.llm.hamming import links
from storelens.llm.scratch import drop, new_folder, stored
from storelens.llm.text import content_key, whole

SEED = 42
CHUNK = 1 << 15


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of all shingles in order: A-Z lowered, words between ASCII white space, joined
    by a space.  Fewer words than ``size`` make one shingle; no words make none."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(found)
    if len(found) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: -size].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())], dtype=np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as an unsigned number; 0 for none."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(``doc_id``, ``fp``): the majority bits of each text's shingles, as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [majority(shingle_hashes(t, size)) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "fp": np.array(fps, dtype=np.uint64).astype(np.int64)
            })

    # ids travel as text: a pandas column of longs with nulls would turn into floats
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole("text").alias("text"))
    out = ids.mapInPandas(run, "doc_id string, fp long")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "fp")


def simhash_components(docs: DataFrame, size: int = 3, max_distance: int = 2) -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``) for every row of ``docs``.

    Documents whose fingerprints differ in at most ``max_distance`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable.  A text without words (null,
    empty, white space) has fingerprint 0 and is linked like any other.  Rows with a null
    id take part; a component that holds only such rows has a null id.  Repeated rows are
    returned as often as given; an empty table gives an empty table.  Other columns of
    ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    fps_path = new_folder(spark, "fingerprints")
    fps = stored(fingerprints(docs, size), fps_path)
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(classes, max_distance))
    # Only fingerprints with a neighbour are in ``found``; all others are their own class.
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = simhash_components(docs, size=3, max_distance=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SAMPLES = 10
SAMPLED = 3
PARITY_WORDS = 16  # of the narrowest table
SAMPLE_TEXTS = 4000
COMMON = 1 << 17
BROADCAST_SHINGLES = 1 << 20
BROADCAST_IDS = 1 << 20
_RANDOM = np.random.default_rng(SEED)
MULTIPLIERS = _RANDOM.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH = "node binary, n int, fp long, samples array<long>, parity array<long>, shingles array<long>"


def words_hash(text: str) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(text.encode("utf-8", "surrogatepass").lower().split()))


def parity(own: np.ndarray) -> np.ndarray:
    """A bit table, at least as wide as the set is large, in which every member turns one bit
    over.  Two tables differ in no more bits than their sets have members that are in one
    alone.  A table twice as wide becomes the narrower one by laying its halves together."""
    width = 1 << max(len(own) - 1, 64 * PARITY_WORDS - 1).bit_length()
    at = (own & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def sketch(text: str, size: int) -> tuple[bytes, int, int, list[int], list[int], np.ndarray]:
    """What a text is compared by: a 128-bit hash of its words, its number of different
    shingles, its fingerprint, the fingerprints of SAMPLES small samples, the parities of
    its shingles, and the shingles themselves, sorted.

    A sample holds the SAMPLED shingles that come first in one pseudo-random order of all
    shingles, so texts of similarity s draw the same sample with a chance of about s^3,
    and at least one of ten equal samples with 0.999 at s = 0.8.
    """
    hashes = shingle_hashes(text, size)
    own = np.unique(hashes)
    drawn = []
    for m in MULTIPLIERS if len(own) else ():
        order = own * m
        order ^= order >> np.uint64(32)
        k = min(SAMPLED, len(own))
        first = own[np.argpartition(order, k - 1)[:k]]
        drawn.append(majority(first))
    signed = np.array([majority(hashes), *drawn], dtype=np.uint64).astype(np.int64).tolist()
    return words_hash(text), len(own), signed[0], signed[1:], parity(own).tolist(), own.astype(np.int64)


def _sketches(size: int):
    @F.pandas_udf(SKETCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        columns = ["node", "n", "fp", "samples", "parity", "shingles"]
        for texts in batches:
            yield pd.DataFrame([sketch(t, size) for t in texts], columns=columns)

    return run


def _common_shingles(slim: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles met most often in a sample of the texts, sorted, and how often.

    They only order the shingles of a set, so what the sample misses costs time alone.
    """
    share = min(1.0, SAMPLE_TEXTS / max(slim.count(), 1))
    drawn = slim.select("node", "shingles").filter(
        F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    ).dropDuplicates(["node"])
    met = drawn.select(F.explode("shingles").alias("x")).groupBy("x").count().filter("count > 1")
    most = met.orderBy(F.desc("count"), "x").limit(COMMON).collect()  # at most COMMON rows
    found = np.array([r["x"] for r in most], dtype=np.int64).astype(np.uint64)
    order = np.argsort(found)
    return found[order], np.array([r["count"] for r in most], dtype=np.int64)[order]


def needed(n: int, m: int, similarity: float) -> int:
    """Shared shingles without which sets of ``n`` and ``m`` cannot be similar enough; a
    hair too low rather than too high."""
    return max(1, int(np.ceil(similarity / (1 + similarity) * (n + m) - 1e-6)))


def prefix(own: np.ndarray, common: np.ndarray, often: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of a set, rarest first, as far as a similar set must share one of them.

    The first shared shingle has all shared ones behind it, and the smallest set that may
    be similar has ``similarity`` times as many shingles.
    """
    at = np.searchsorted(common, own)
    at[at == len(common)] = 0
    weight = np.where(common[at] == own, often[at], 0) if len(common) else np.zeros(len(own), dtype=np.int64)
    least = needed(len(own), int(np.ceil(similarity * len(own) - 1e-6)), similarity)
    return own[np.argsort(weight, kind="stable")][: max(len(own) - least + 1, 0)]


def _prefixes(common: np.ndarray, often: np.ndarray, similarity: float):
    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sets in batches:
            yield pd.Series([
                prefix(np.asarray(own, dtype=np.int64).astype(np.uint64), common, often, similarity).astype(np.int64)
                for own in sets
            ])

    return run


def _pairs_across(sets: DataFrame, similarity: float, path: str) -> DataFrame:
    """Pairs (``a``, ``b``) of ids in different groups that can be similar: exact.

    ``sets`` has ``id``, ``n`` (its number of shingles), ``root`` (its group) and ``p`` (its
    prefix).  Of two similar sets the first shared shingle has at least the needed number
    behind it in both.  Shingles that one group alone holds, as in a large group of near
    copies, meet nothing; those of several groups are written to ``path`` first, so that
    all others are not shuffled with their ids.
    """
    held = sets.select("root", F.explode("p").alias("x")).groupBy("x").agg(F.min("root").alias("_1"), F.max("root").alias("_2"))
    across = stored(held.filter("_1 <> _2").select("x"), path)
    if across.count() <= BROADCAST_SHINGLES:
        across = F.broadcast(across)
    shared = sets.select("id", "n", "root", F.posexplode("p").alias("i", "x")).join(across, "x")
    # the smaller set of a pair needs at least 2 s / (1 + s) of its own shingles
    short = shared.filter(F.col("n") - F.col("i") >= 2 * similarity / (1 + similarity) * F.col("n") - 1e-6)
    short = short.select("x", *(F.col(c).alias(f"_{c}") for c in ("id", "n", "root", "i")))
    least = similarity / (1 + similarity) * (F.col("n") + F.col("_n")) - 1e-6
    return shared.join(short, "x").filter(
        (F.col("root") != F.col("_root")) & (F.struct("_n", "_id") < F.struct(F.col("n"), F.col("id")))
        & (F.col("_n") >= similarity * F.col("n") - 1e-6)
        & (F.col("n") - F.col("i") >= least) & (F.col("_n") - F.col("_i") >= least)
    ).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def _candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of ids: whole fingerprints within two bits, or an equal sample.

    They gather large groups cheaply; what they miss is left to :func:`_pairs_across`.
    The members of a bucket meet its first one alone, the same in all bands where it can
    be, so k copies make some k pairs.
    """
    classes = nodes.groupBy("fp").agg(F.min("id").alias("a"))
    near = links(classes, 2).join(classes.select(F.col("fp").alias("a"), F.col("a").alias("na")), "a").join(
        classes.select(F.col("fp").alias("b"), F.col("a").alias("nb")), "b"
    ).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    same = nodes.select("fp", "id").join(classes, "fp").select("a", F.col("id").alias("b"))
    drawn = nodes.select("id", F.posexplode("samples").alias("band", "sample"))
    key = ["band", "sample"]
    centres = drawn.groupBy(*key).agg(F.min("id").alias("a"), F.count("*").alias("k")).filter("k > 1").drop("k")
    sampled = drawn.join(centres, key).select("a", F.col("id").alias("b"))
    return near.union(same).union(sampled).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).filter("a < b").distinct()


def _can_be(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of the ``pairs`` that numbers and parities of shingles allow; loses no similar
    pair.  A table has a bit or two per member, so few sets have to meet."""
    facts = nodes.select("id", "n", "parity")
    m, one, other = F.col("m"), F.col("parity"), F.col("other")

    def halved(table: Column) -> Column:
        half = F.floor(F.size(table) / 2).cast("int")
        return F.zip_with(F.slice(table, F.lit(1), half), F.slice(table, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    def apart(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)

    # sets near enough in size have tables of one width, or one of them twice the other's
    narrow, wide = F.size(one) < F.size(other), F.size(one) > F.size(other)
    bits = F.when(narrow, apart(one, halved(other))).when(wide, apart(halved(one), other)).otherwise(apart(one, other))
    return (
        pairs.join(facts.withColumnRenamed("id", "a"), "a")
        .join(facts.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("parity").alias("other")), "b")
        .filter(F.least("n", m) >= similarity * F.greatest("n", m) - 1e-6)
        .filter((1 + similarity) * bits <= (1 - similarity) * (F.col("n") + m) + 1e-6)
        .select("a", "b")
    )


def _similar(slim: DataFrame, pairs: DataFrame, similarity: float, path: str) -> DataFrame:
    """Those of the ``pairs`` (a table) whose sets are similar enough, written to ``path``."""
    spark = slim.sparkSession
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted_path, set_path = new_folder(spark, "wanted"), new_folder(spark, "shingle-sets")
    wanted = stored(wanted, wanted_path)
    few = wanted.count() <= BROADCAST_IDS  # then the sets of all others are not shuffled
    sets = stored(slim.select("id", "shingles").join(F.broadcast(wanted) if few else wanted, "id"), set_path)
    shared = F.size(F.array_intersect("s", "t"))
    linked = stored(
        # the ends that come up once meet first; then the groups' centres
        pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a")
        .filter(shared >= similarity * (F.size("s") + F.size("t") - shared)).select("a", "b"),
        path,
    )
    drop(spark, set_path, wanted_path)
    return linked


def keep_one_per_group(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text`` and any others) without near copies.

    Two texts are linked if their sets of ``size``-word shingles have a Jaccard similarity
    of at least ``similarity``; equal word sequences always are.  Of each linked group the
    row with the smallest ``doc_id`` stays (a null id sorts last, then the words' hash
    decides; of repeated rows one stays).  Texts without words form one group.

    Candidates come from :func:`hamming.links` and from equal samples; all pairs still in
    different groups then meet by their rarest shingles, which misses none.  Parities rule
    most candidates out, and the rest are checked by their shingle sets.  An empty table gives an empty table.  Names that start with
    ``_`` are reserved.
    """
    spark = docs.sparkSession
    raw = dict(zip(["_c1", "_c2"], content_key(whole("text"))))
    paths: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        paths.append(new_folder(spark, name))
        return stored(df, paths[-1])

    # Each text is split and hashed here alone; all that follows reads this table.
    slim = docs.withColumns(raw).withColumns({"id": F.monotonically_increasing_id(), "_s": _sketches(size)(whole("text"))})
    slim = kept(slim.select("doc_id", *raw, "id", "_s.*"), "sketches")
    nodes = kept(slim.groupBy("node").agg(
        F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "fp", "samples", "parity"))
    ), "nodes")

    pairs = kept(_can_be(_candidates(nodes), nodes, similarity), "copy-pairs")
    groups = components(_similar(slim, pairs, similarity, new_folder(spark, "copy-links")))
    groups = kept(groups.withColumnRenamed("node", "id"), "groups")

    # exact, for all pairs that are not in one group yet
    rooted = nodes.select("id", "n").filter("n > 0").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rare_first = _prefixes(*_common_shingles(slim), similarity)
    sets = kept(slim.select("id", rare_first("shingles").alias("p")).join(rooted, "id"), "prefixes")
    met = kept(_pairs_across(sets, similarity, new_folder(spark, "shared-shingles")), "met-pairs")
    across = kept(_can_be(met, nodes, similarity), "across-pairs")
    more = _similar(slim, across, similarity, new_folder(spark, "more-links"))
    named = groups.withColumnRenamed("root", "_root")
    ends = more.join(named.withColumnRenamed("id", "a"), "a", "left").select(
        F.coalesce("_root", "a").alias("a"), "b"
    ).join(named.withColumnRenamed("id", "b"), "b", "left").select("a", F.coalesce("_root", "b").alias("b"))
    merged = components(ends).select(F.col("node").alias("_group"), F.col("root").alias("_merged"))
    roots = nodes.select("node", "id").join(groups, "id", "left").select("node", F.coalesce("root", "id").alias("_group"))
    roots = kept(roots.join(merged, "_group", "left").select("node", F.coalesce("_merged", "_group").alias("root")), "roots")

    rooted = slim.select("doc_id", "node", *raw).join(roots, "node")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    stays = rooted.groupBy("root").agg(F.min(order).alias("least"), F.count("*").alias("k")).filter("k > 1")
    # written, so that the join below meets it by a shuffle of its own and can split a
    # group that very many documents are in
    stays = kept(stays, "survivors")
    goes_path = new_folder(spark, "copies")
    judged = rooted.join(stays, "root").select("doc_id", *raw, "node", "least")
    loses = ~(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("node") == F.col("least.node")))
    goes = stored(judged.filter(loses).select("doc_id", *raw).distinct(), goes_path)
    repeats = slim.groupBy(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).count().filter("count > 1")

    def raw_is(other: DataFrame, id_name: str) -> list:
        return [docs["doc_id"].eqNullSafe(other[id_name]), *(expr == other[c] for c, expr in raw.items())]

    out = docs.join(goes, raw_is(goes, "doc_id"), "left_anti")
    if repeats.isEmpty():
        drop(spark, *paths)
        return out
    # rows repeated as a whole, which the anti-join cannot tell apart
    known = slim.join(repeats, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("node") == F.col("_node")))
    known = stored(known.select("_id", "_node", *raw).distinct(), new_folder(spark, "repeated"))
    drop(spark, *paths)
    once = out.join(known, raw_is(known, "_id"), "left_anti")
    twice = out.join(known, raw_is(known, "_id")).dropDuplicates(["_id", "_node"])
    return once.unionByName(twice.select(*docs.columns))
