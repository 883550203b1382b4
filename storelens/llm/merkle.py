"""Merkle manifest of a dataset: a SHA-256 tree that keeps hash states.

The rows of a group, in order, are the leaves of one tree, and the groups' roots the
leaves of the tree above.  A node is the hash of its children's digests laid end to end,
so a parent is hashed child by child, and the state of the hash before each child is
copied and kept.  To see what the root becomes when a child changes, the state before
that child is resumed with the replacement and with what stands to its right; nothing to
the left of it is read again.

Trees are cut into runs of ``fanout ** depth`` nodes.  A run is one small group of rows:
one pass makes it a node of the level above, so a tree of any size takes a few passes,
and a group with a third of all rows is many runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.scratch import new_folder, stored
from storelens.operators.ranking import number_rows

FANOUT, DEPTH = 2, 9
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "grp string, n long, pos long, digest string"
STEP = "struct<left: string, right: string>"
PATH = f"grp string, pos long, subroot string, root string, path array<{STEP}>"
FOLDED = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 of the fields laid end to end."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """The group as text that is never null and sorts as the group does, null first."""
    return F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))


# --- inside a run --------------------------------------------------------------------


def run_levels(digests: list[bytes], fanout: int, height: int | None) -> tuple[list[list[bytes]], list[list[list]]]:
    """The levels of a run from its nodes up, and for every parent the copied hash states
    before each of its children; ``height`` levels, or as many as lead to one node."""
    levels, states = [digests], []
    while len(levels[-1]) > 1 if height is None else len(states) < height:
        below, row, kept = levels[-1], [], []
        for first in range(0, len(below), fanout):
            h, before = sha256(), []
            for digest in below[first : first + fanout]:
                before.append(h.copy())
                h.update(digest)
            row.append(h.hexdigest().encode())
            kept.append(before)
        levels.append(row)
        states.append(kept)
    return levels, states


def siblings(level: list[bytes], at: int, fanout: int) -> tuple[bytes, bytes]:
    """The digests left and right of a node under its parent, laid end to end."""
    first = at - at % fanout
    return b"".join(level[first:at]), b"".join(level[at + 1 : first + fanout])


def _height(n: int, fanout: int, depth: int) -> int | None:
    """A run of a tree with other runs is as high as a full one."""
    return depth if n > fanout**depth else None


def _sorted_run(table: pa.Table) -> tuple[pa.Table, list[bytes], int]:
    table = table.sort_by("pos")
    return table, [d.encode() for d in table["digest"].to_pylist()], table["n"][0].as_py()


# --- trees of any size -----------------------------------------------------------------


def _runs(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    return nodes.withColumn("run", F.floor(F.col("pos") / fanout**depth).cast("long"))


def forest(leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> list[DataFrame]:
    """Tables (``grp``, ``n``, ``pos``, ``digest``) from the given leaves to one node a group.

    ``n`` is the number of the group's nodes in that table and ``pos`` counts them from 0.
    There is one table for every ``depth`` levels of the trees.
    """
    spark = leaves.sparkSession

    def top(table: pa.Table) -> pa.Table:
        table, digests, n = _sorted_run(table)
        levels, _ = run_levels(digests, fanout, _height(n, fanout, depth))
        return pa.table({
            "grp": table["grp"][:1], "n": pa.array([-(-n // fanout**depth)], pa.int64()), "pos": table["run"][:1],
            "digest": [levels[-1][0].decode()],
        })

    tables, most = [leaves], None
    while most is None or most > 1:
        above = _runs(tables[-1], fanout, depth).groupBy("grp", "run").applyInArrow(top, NODE)
        tables.append(stored(above, new_folder(spark, "merkle-level")))
        most = tables[-1].agg(F.max("n")).first()[0] or 0
    return tables


def _paths(nodes: DataFrame, above: DataFrame, fanout: int, depth: int) -> DataFrame:
    """The way from each node to the root: what stands left and right of it at every level.
    ``above`` has the ways of the runs' own nodes."""

    def lead(rows: pa.Table, parents: pa.Table) -> pa.Table:
        rows, digests, n = _sorted_run(rows)
        levels, _ = run_levels(digests, fanout, _height(n, fanout, depth))
        upper = parents["path"][0].as_py()
        ways = []
        for i in range(len(digests)):
            own = [siblings(level, i // fanout**j, fanout) for j, level in enumerate(levels[:-1])]
            ways.append([{"left": a.decode(), "right": b.decode()} for a, b in own] + upper)
        step = pa.struct([("left", pa.string()), ("right", pa.string())])
        k = len(ways)
        return pa.table({
            "grp": rows["grp"], "pos": rows["pos"], "subroot": [parents["subroot"][0].as_py()] * k,
            "root": [parents["root"][0].as_py()] * k, "path": pa.array(ways, pa.list_(step)),
        })

    keyed = _runs(nodes, fanout, depth)
    return keyed.groupBy("grp", "run").cogroup(
        above.withColumnRenamed("pos", "run").groupBy("grp", "run")
    ).applyInArrow(lead, PATH)


def _ways_of_runs(tables: list[DataFrame], ends: DataFrame, fanout: int, depth: int) -> DataFrame:
    """The ways of the first level's runs; ``ends`` has those of the groups' roots."""
    ways = ends
    for nodes in tables[-2:0:-1]:
        ways = _paths(nodes, ways, fanout, depth)
    return ways


@dataclass(frozen=True)
class Manifest:
    """The trees of a dataset: ``levels`` from the leaves to the groups' roots, ``top`` from
    those to the root, and the ways from the leaves' runs to the root."""

    levels: list[DataFrame]
    top: list[DataFrame]
    ways: DataFrame
    fanout: int
    depth: int

    @property
    def root(self) -> str | None:
        """The root's digest; none for an empty dataset."""
        row = self.top[-1].first()
        return row and row["digest"]


def manifest(leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> Manifest:
    """The trees over ``leaves`` (``grp`` without nulls, ``doc_id``, ``digest``, others), written
    to the shared folder level by level.

    A group's leaves come in order of ``doc_id``, null first, then digest; rows that are
    equal in all three are leaves each.  Groups come in order of ``grp``.  The columns
    ``pos`` and ``n`` are added to the leaves.
    """
    spark = leaves.sparkSession
    numbered = number_rows(leaves, ["grp", "doc_id", "digest"], "_overall")
    groups = numbered.groupBy(F.col("grp").alias("_grp")).agg(F.count("*").alias("n"), F.min("_overall").alias("_first"))
    placed = numbered.join(groups, F.col("grp") == F.col("_grp")).withColumn(
        "pos", F.col("_overall") - F.col("_first")
    ).drop("_grp", "_first", "_overall")
    levels = forest(stored(placed, new_folder(spark, "merkle-leaves")), fanout, depth)

    roots = levels[-1].select("grp", F.col("digest").alias("subroot"))
    several = number_rows(roots, ["grp"], "_at").select(
        F.lit("").alias("grp"), (F.col("_at") - 1).alias("pos"), F.col("subroot").alias("digest"), F.col("grp").alias("name")
    )
    many = F.lit(levels[-1].count()).cast("long")
    first = stored(several.select("grp", many.alias("n"), "pos", "digest", "name"), new_folder(spark, "merkle-roots"))
    top = forest(first.drop("name"), fanout, depth)
    none = F.array().cast(f"array<{STEP}>")
    end = top[-1].select("grp", "pos", F.lit("").alias("subroot"), F.col("digest").alias("root"), none.alias("path"))
    to_root = _paths(top[0], _ways_of_runs(top, end, fanout, depth), fanout, depth)
    ends = to_root.join(first.select("pos", "digest", "name"), "pos").select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "path"
    )
    return Manifest(levels, top, _ways_of_runs(levels, ends, fanout, depth), fanout, depth)


def folded(made: Manifest) -> DataFrame:
    """For every leaf of the manifest: the proof's digest and the root that comes out when
    the leaf is its ``replacement`` (a column of the leaves; null: as it is).

    The proof is the leaf's siblings at every level up to the root, from left to right.
    """
    fanout, depth = made.fanout, made.depth

    def fold(rows: pa.Table, parents: pa.Table) -> pa.Table:
        rows, digests, n = _sorted_run(rows)
        levels, states = run_levels(digests, fanout, _height(n, fanout, depth))
        # above the run all leaves have the same way: one state before it at every level
        upper = [(sha256(s["left"].encode()), s["right"].encode()) for s in parents["path"][0].as_py()]
        rest = "".join(s["left"] + s["right"] for s in parents["path"][0].as_py()).encode()
        proofs, roots = [], []
        for i, (digest, replacement) in enumerate(zip(digests, rows["replacement"].to_pylist())):
            now = digest if replacement is None else replacement.encode()
            proof, at = sha256(), i
            for level, kept in zip(levels, states):
                left, right = siblings(level, at, fanout)
                proof.update(left + right)
                h = kept[at // fanout][at % fanout].copy()
                h.update(now + right)
                now, at = h.hexdigest().encode(), at // fanout
            for before, right in upper:
                h = before.copy()
                h.update(now + right)
                now = h.hexdigest().encode()
            proof.update(rest)
            proofs.append(proof.hexdigest())
            roots.append(now.decode())
        k = len(digests)
        return pa.table({
            "doc_id": rows["doc_id"], "leaf": rows["digest"], "subroot": [parents["subroot"][0].as_py()] * k,
            "root": [parents["root"][0].as_py()] * k, "proof_sha256": proofs, "folded_root": roots,
        })

    leaves = made.levels[0].withColumn("doc_id", F.col("doc_id").cast("string"))
    return _runs(leaves.select("grp", "n", "pos", "digest", "doc_id", "replacement"), fanout, depth).groupBy(
        "grp", "run"
    ).cogroup(made.ways.withColumnRenamed("pos", "run").groupBy("grp", "run")).applyInArrow(fold, FOLDED)


def audit(docs: DataFrame, tampered: Column, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``,
    ``verified``) for every row of ``docs`` (the columns of :data:`COLUMNS`).

    The tree has one part per ``lang``.  Where ``tampered`` is true the row's ``n_chars`` is
    taken as one more (a null stays), and ``folded_root`` is what the root becomes by that;
    ``verified`` says that it is still the root.

    Nulls of any column are fields of their own, apart from empty texts; a null ``lang`` is
    a part.  Rows come in order of ``doc_id``, null first, then of their digest; repeated
    rows are leaves each.  ``doc_id`` is a whole number.  An empty table gives an empty
    table; other columns are not looked at.
    """
    spark = docs.sparkSession
    values = [F.col(c) for c in COLUMNS]
    # one wider than a long, so that the largest number has a next one
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    slim = docs.select(
        group_key(F.col("lang")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(*values).alias("digest"), F.when(tampered, leaf_digest(*changed)).alias("replacement"),
    )
    # written, so that sorting by digest does not hash the texts again
    made = manifest(stored(slim, new_folder(spark, "merkle-digests")), fanout, depth)
    return folded(made).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    return audit(docs, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _sql_leaf(**changed: str) -> str:
    return "sha256(" + " || ".join(_sql_field(changed.get(c, c)) for c in COLUMNS) + ")"


def _sql_fold(name: str, rows: str, tree: str) -> str:
    """Digests ``d`` of ``rows`` (``g``, ``place``, ``id``, ``d``) led up ``tree``."""
    return f"""
{name} AS (
    SELECT id, g, 0 AS level, place, d FROM {rows}
    UNION ALL
    SELECT f.id, f.g, f.level + 1, f.place // 2,
        sha256(CASE WHEN f.place % 2 = 0 THEN f.d || coalesce(s.digest, '') ELSE s.digest || f.d END)
    FROM {name} f JOIN {tree} o ON o.g = f.g AND o.level = f.level AND o.pos = f.place AND o.n > 1
    LEFT JOIN {tree} s ON s.g = f.g AND s.level = f.level AND s.pos = xor(f.place, 1))"""


def _sql_tree(name: str, nodes: str) -> str:
    return f"""
{name} AS (
    SELECT g, 0 AS level, pos, digest, n FROM {nodes}
    UNION ALL
    SELECT g, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY g, level, n, pos // 2)"""


OP11_SQL = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g, {_sql_leaf()} AS digest,
        {_sql_leaf(n_chars='(n_chars + 1)')} AS other,
        xor(list_reduce([4294967295] || [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
            lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
            4294967295) % 7 = 0 AS tampered
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
        count(*) OVER (PARTITION BY g) AS n FROM hashed),
{_sql_tree("tree", "leaves")},
roots AS (
    SELECT '' AS g, g AS name, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
{_sql_tree("top", "roots")},
started AS (
    SELECT g, pos AS place, g || ':' || CAST(pos AS VARCHAR) AS id, CASE WHEN tampered THEN other ELSE digest END AS d FROM leaves),
{_sql_fold("low", "started", "tree")},
between AS (
    SELECT '' AS g, r.pos AS place, l.id, l.d FROM low l JOIN tree t ON t.g = l.g AND t.level = l.level AND t.pos = l.place AND t.n = 1
    JOIN roots r ON r.name = l.g),
{_sql_fold("high", "between", "top")},
ends AS (SELECT h.id, h.d AS folded_root FROM high h JOIN top t ON t.level = h.level AND t.pos = h.place AND t.n = 1),
beside AS (
    SELECT l.id, l.level, s.digest FROM low l JOIN tree s ON s.g = l.g AND s.level = l.level AND s.pos = xor(l.place, 1)
    UNION ALL
    SELECT h.id, 1000 + h.level, s.digest FROM high h JOIN top s ON s.level = h.level AND s.pos = xor(h.place, 1)),
proofs AS (SELECT id, sha256(string_agg(digest, '' ORDER BY level)) AS proof FROM beside GROUP BY id)
SELECT l.doc_id, l.digest AS leaf, r.digest AS subroot, t.digest AS root,
    coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = t.digest AS verified
FROM leaves l JOIN roots r ON r.name = l.g JOIN top t ON t.n = 1
JOIN ends e ON e.id = l.g || ':' || CAST(l.pos AS VARCHAR)
LEFT JOIN proofs p ON p.id = l.g || ':' || CAST(l.pos AS VARCHAR)
"""
