"""Secret scans: fixed patterns, and character Markov models for what has no pattern.

Two first-order models over the characters of keys and identifiers are counted on the
whole corpus: one on the strings that the patterns found (random strings), one on all
other runs of such characters (ordinary words and identifiers).  A long run is a secret
if its log-likelihood ratio is high enough.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.text import whole

# fixed values: the patterns of the base kinds
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
EDGE = len(ALPHABET)  # whatever is no character of the alphabet
STATES = EDGE + 1
CODES = np.full(256, EDGE, dtype=np.int64)
CODES[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(EDGE)

Span = tuple[int, str, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start and kind, in code points."""
    low = text.lower()
    spans: list[Span] = []
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # runs are maximal either way: a search for long ones skips the short ones
    spans += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def secret_strings(text: str, spans: list[Span]) -> list[str]:
    """What the spans hide: the assigned value, or the span itself."""
    return [ASSIGN.match(text, a).group(2) if kind == "assign" else text[a:b] for a, kind, b in spans]


def transitions(text: str) -> np.ndarray:
    """Counts of neighbouring characters, from and to the edge included."""
    codes = CODES[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES * STATES)


def count_transitions(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Transition counts of random strings and of everything else, over all of ``docs``."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, STATES * STATES), dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                own = np.zeros(STATES * STATES, dtype=np.int64)
                for found in secret_strings(text, base_spans(text)):
                    own += transitions(found)
                total[0] += own
                total[1] += np.maximum(transitions(text) - own, 0)
        which, pair = np.nonzero(total)
        yield pd.DataFrame({"which": which, "pair": pair, "n": total[which, pair]})

    rows = docs.select(whole("text").alias("text")).mapInPandas(count, "which int, pair int, n long")
    total = np.zeros((2, STATES * STATES), dtype=np.int64)
    for which, pair, n in rows.groupBy("which", "pair").agg(F.sum("n")).collect():  # at most 2 * 69^2 rows
        total[which, pair] = n
    return total[0].reshape(STATES, STATES), total[1].reshape(STATES, STATES)


def ratio_table(random: np.ndarray, ordinary: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log P(next | last, random) - log P(next | last, ordinary), each count smoothed."""

    def log_chance(counts: np.ndarray) -> np.ndarray:
        inside = counts[:, :EDGE] + smoothing
        return np.log(inside / inside.sum(axis=1, keepdims=True))

    return log_chance(random) - log_chance(ordinary)


def score(run: str, table: np.ndarray) -> float:
    """The log-likelihood ratio of a run of alphabet characters."""
    codes = CODES[np.frombuffer(f" {run}".encode(), dtype=np.uint8)]
    return float(table[codes[:-1], codes[1:]].sum())


def uncovered(start: int, end: int, base: Iterable[Span]) -> Iterator[tuple[int, int]]:
    """What the base spans, by start, leave of a run."""
    for a, _, b in base:
        if a >= end:
            break
        if start < a:
            yield start, a
        start = max(start, b)
    if start < end:
        yield start, end


def markov_spans(text: str, base: list[Span], table: np.ndarray, min_length: int, min_ratio: float) -> list[Span]:
    """Runs of at least ``min_length`` alphabet characters, or what the base spans leave of
    them if it is as long, whose ratio is ``min_ratio`` or more."""
    out, first = [], 0
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]{%d,}" % min_length, text):
        while first < len(base) and base[first][2] <= m.start():
            first += 1
        for a, b in uncovered(m.start(), m.end(), islice(base, first, None)):
            if b - a >= min_length and score(text[a:b], table) >= min_ratio:
                out.append((a, "markov", b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, table: np.ndarray, min_length: int = 16, min_ratio: float = 10.0) -> DataFrame:
    """(``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_markov``, ``base_sha256``,
    ``spans``) per row of ``docs``.

    A run counts as random from odds of e^``min_ratio`` to one on.  ``spans`` lists kind:start:end (code points, end exclusive) by start and kind;
    ``base_sha256`` is the digest of the same list without Markov spans.  A null text is
    empty and has no spans.  Repeated rows and null ids are scanned like any other; an
    empty table gives an empty table.  Other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                base = base_spans(text)
                extra = markov_spans(text, base, table, min_length, min_ratio)
                every = sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[1])))
                kinds = [kind for _, kind, _ in every]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((doc_id, *(kinds.count(k) for k in KINDS), digest, joined(every)))
            yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    schema = "doc_id string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole("text").alias("text"))
    return ids.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, ratio_table(*count_transitions(docs)))
