import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storelens.llm import mixing, packing

from tests.llm.tools import documents, table_rows


@pytest.mark.parametrize("weights", [
    {"a": 1}, {"a": 1, "b": 1}, {"a": 3, "b": 1}, {"a": 500, "b": 333, "c": 100, "d": 67},
    {f"s{i}": 1 + i % 7 for i in range(60)},
])
def test_deviation_stays_below_a_block(weights):
    period, slots = sum(weights.values()), mixing.pfair_slots(weights)
    owner = {t: k for k, own in slots.items() for t in own}
    assert sorted(owner) == list(range(period))
    given = Counter()
    for t in range(period):
        given[owner[t]] += 1
        for k, w in weights.items():
            assert abs(given[k] - w * (t + 1) / period) < 1
    assert given == Counter(weights)


def test_whole_weights():
    assert mixing.whole_weights({}, 10) == {}
    got = mixing.whole_weights({"a": 1.0, "b": 2.0, "c": 1e-9}, 1000)
    assert sum(got.values()) == 1000 and got["c"] >= 1 and abs(got["b"] - 2 * got["a"]) <= 3
    assert sum(mixing.whole_weights({str(i): 1 + i for i in range(300)}, 1000).values()) == 3000
    with pytest.raises(ValueError):
        mixing.whole_weights({"a": 0}, 10)


def test_small_sources_get_their_share_alone():
    assert mixing.whole_weights({"a": 0.999, "b": 0.001}, 1000) == {"a": 999, "b": 1}
    many = mixing.whole_weights({"hot": 2500.0} | {f"s{i}": 1.0 for i in range(5000)}, 1000)
    assert sum(many.values()) == 50_010 and many["hot"] == 16_670


@pytest.mark.parametrize("shares, blocks", [
    ({"a": 0.999, "b": 0.001}, {"a": 3000, "b": 2}), ({"a": 1.0, "b": 2.0**0.5, "c": 1e-7}, {"a": 70, "b": 900, "c": 1}),
    ({"hot": 2500.0} | {f"s{i}": 1.0 for i in range(5000)}, {"hot": 4000} | {f"s{i}": 1 for i in range(5000)}),
    ({"a": 5.0}, {"a": 3}),
])
def test_whole_mix_keeps_to_the_targets(shares, blocks):
    weights, total = mixing.fitted_weights(shares, blocks), sum(shares.values())
    period = sum(weights.values())
    assert all(weights[k] >= blocks[k] and abs(weights[k] - shares[k] / total * period) < 1 for k in shares)
    for k, own in mixing.pfair_slots(weights).items():
        for j, t in enumerate(own):  # before and after each block of the source
            assert abs(j - shares[k] / total * t) < 2 and abs(j + 1 - shares[k] / total * (t + 1)) < 2


def test_mix_query_keeps_to_the_targets(spark):
    rows = [(i, "x" * 100, "a") for i in range(1999)] + [(5000 + i, "x" * 100, "b") for i in range(2)]
    got = mixing.mixed(documents(spark, rows), {"a": 0.999, "b": 0.001}, block_chars=100).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in rows}
    for t in range(1 + max(r.slot for r in got)):
        assert abs(sum(r.slot <= t and r.source == "b" for r in got if r.source == "b") - 0.001 * (t + 1)) < 2


def texts(n=400, seed=1):
    r = random.Random(seed)
    rows = [(i, "x" * r.randrange(300), r.choice(["a", "a", "a", "b", None])) for i in range(n)]
    return rows + [(n, None, "c"), (n + 1, "", "c"), (None, "x" * 50, "b"), (5, "x" * 20, "a"), (5, "x" * 20, "a")]


def test_mix_keeps_shares_and_every_document(spark):
    rows, size, period = texts(), 500, 100
    weights = {"a": 5.0, "b": 3.0, None: 2.0, "c": 1.0}
    docs = documents(spark, rows).withColumn("slot", F.lit("old"))
    out = mixing.mixed(docs, weights, period=period, block_chars=size)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "epoch", "block", "slot", "place"]
    got = out.collect()
    first = Counter((r.doc_id, r.text, r.source) for r in got if r.epoch == 0)
    assert first == Counter(rows)
    # laid end to end without gaps
    ends = defaultdict(list)
    for r in got:
        if r.epoch == 0:
            ends[r.source].append((r.place, r.place + len(r.text or "")))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    blocks = {s: max(1, -(-max(e for _, e in spans) // size)) for s, spans in ends.items()}
    assert all(r.block == min(r.place // size, blocks[r.source] - 1) for r in got)
    # the schedule, slot by slot
    keys = {None if k == "0" else k[1:]: k for k in mixing.whole_weights({"1a": 5.0, "1b": 3.0, "0": 2.0, "1c": 1.0}, period)}
    whole = mixing.whole_weights({"1a": 5.0, "1b": 3.0, "0": 2.0, "1c": 1.0}, period)
    slots = mixing.pfair_slots(whole)
    for r in got:
        w, own = whole[keys[r.source]], slots[keys[r.source]]
        turn = r.epoch * blocks[r.source] + r.block
        assert r.slot == turn // w * period + own[turn % w]
    # the slot of the last block of the slowest source; no document need start in that block
    last = max(b // whole[keys[s]] * period + slots[keys[s]][b % whole[keys[s]]] for s, b in ((s, n - 1) for s, n in blocks.items()))
    assert max(r.slot for r in got) <= last
    for s, n in blocks.items():  # nothing granted is left out
        w, own = whole[keys[s]], slots[keys[s]]
        granted = sum(1 for t in range(last + 1) if t % period in set(own))
        seen = {r.epoch * n + r.block for r in got if r.source == s}
        empty = {b for b in range(n)} - {r.block for r in got if r.source == s}
        assert seen == {t for t in range(granted) if t % n not in empty}


def test_mix_order_and_empty(spark):
    rows = mixing.in_order(mixing.mixed(documents(spark, texts()), block_chars=300)).collect()
    assert [(r.slot, r.place) for r in rows] == sorted((r.slot, r.place) for r in rows)
    assert mixing.mixed(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        mixing.mixed(documents(spark, texts()), {"a": 1})


def test_mix_query_on_table(spark, sf_dir):
    ids = {i for (i,) in table_rows(sf_dir, "documents", "doc_id")}
    got = mixing.op5_mix_sources(spark, sf_dir).collect()
    assert {r.doc_id for r in got if r.epoch == 0} == ids
    assert Counter((r.doc_id, r.epoch) for r in got).most_common(1)[0][1] == 1
    assert all(len(s) == 1 for s in _by(got, "slot", "source").values())


def _by(rows, key, value):
    out = defaultdict(set)
    for r in rows:
        out[r[key]].add(r[value])
    return out


def plain_best_fit(lengths, opened, sizes):
    room, out = [], []
    for n in lengths:
        fits = [i for i, left in enumerate(room) if left >= n]
        if not fits:
            room.append(opened if opened >= n else min(c for c in sizes if c >= n))
            fits = [len(room) - 1]
        at = min(fits, key=lambda i: (room[i], i))
        room[at] -= n
        out.append(at)
    return out


def test_group_is_best_fit_and_the_cheapest():
    r = random.Random(4)
    sizes = [64, 128, 256]
    for _ in range(30):
        lengths = sorted((r.randrange(0, 257) for _ in range(r.randrange(0, 60))), reverse=True)
        results = []
        for opened in sizes:
            want = plain_best_fit(lengths, opened, sizes)
            got = packing.best_fit(lengths, opened, sizes)
            assert sorted(Counter(zip(got, lengths)).values()) == sorted(Counter(zip(want, lengths)).values())
            used = [sum(n for n, b in zip(lengths, want) if b == i) for i in range(len(set(want)))]
            results.append(sum(min(c for c in sizes if c >= u) + 8 for u in used))
        numbers, shrunk = packing.pack_group(lengths, sizes, 8)
        assert sum(shrunk) + 8 * len(shrunk) == min(results)


def check_packing(rows, lengths, sizes):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.group, r.sequence].append(r)
    for doc_id, n in lengths.items():
        at = 0
        for start, length in sorted(pieces[doc_id]):
            assert start == at
            at += length
        assert at == n
    assert set(pieces) == set(lengths)
    for own in bins.values():
        own.sort(key=lambda r: (r.offset, r.length))
        used = sum(r.length for r in own)
        assert {r.capacity for r in own} == {min(c for c in sizes if c >= used)}
        assert all(a.offset + a.length == b.offset for a, b in zip(own, own[1:])) and own[0].offset == 0


def test_packing(spark):
    r = random.Random(6)
    sizes = (64, 128, 256)
    rows = [(i, "é" * r.randrange(150) if i % 2 else "x" * r.randrange(900)) for i in range(300)]
    rows += [(300, None), (301, ""), (None, "x" * 70), (302, "x" * 255), (303, "x" * 256), (304, "x" * 50_000)]
    lengths = {i: len((t or "").encode()) + 1 for i, t in rows}
    docs = documents(spark, rows).withColumn("group", F.lit("old"))
    check_packing(packing.packed(docs, capacities=sizes, group_rows=90).collect(), lengths, sizes)
    other = packing.packed(docs, F.col("n_chars") * F.when(F.col("doc_id") == 1, None).otherwise(-1), sizes).collect()
    assert len(other) == len(rows) and all(x.length == 0 and x.capacity == 64 for x in other)
    twice = packing.packed(documents(spark, [(1, "x" * 40)] * 3), capacities=sizes).collect()
    assert len(twice) == 3 and sum(x.length for x in twice) == 123
    assert packing.packed(documents(spark, []), capacities=sizes).collect() == []
    with pytest.raises(ValueError):
        packing.packed(docs, capacities=())


def test_packing_query_on_table(spark, sf_dir):
    texts = table_rows(sf_dir, "documents", "doc_id, text")
    rows = packing.op3_best_fit_packing(spark, sf_dir).collect()
    check_packing(rows, {i: len(t.encode()) + 1 for i, t in texts}, packing.CAPACITIES)
    room = {(r.group, r.sequence): r.capacity for r in rows}
    assert sum(r.length for r in rows) > 0.97 * sum(room.values())
