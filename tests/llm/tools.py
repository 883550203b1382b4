"""What the tests of this folder share."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, source="s"):
    """A documents table of (id, text) or (id, text, source) rows."""
    rows = [(t[0], t[1], "en", t[2] if len(t) > 2 else source, len(t[1] or "")) for t in texts]
    return spark.createDataFrame(rows, DOCS)


def table_rows(sf_dir, name, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    found = words(lower(text))
    if not found:
        return []
    return [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]


class Groups:
    """Union-find; a group's name is its smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def similar_groups(texts, size, similarity):
    """Groups of ids by Jaccard similarity of shingle sets, through shared shingles."""
    sets = {i: set(shingles(t, size)) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s or {""}:
            holders[x].append(i)
    shared = Counter()
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                shared[tuple(sorted((a, b)))] += 1
    groups = Groups(sets)
    for (a, b), n in shared.items():
        if not sets[a] and not sets[b] or n >= similarity * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {i: groups.find(i) for i in sets}
