"""Range join, periodic runs and hard negatives against brute force."""

import hashlib
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from urlwarden.llm import negatives, periodic, queries, rangejoin

ROWS = "vec_id bigint, embedding array<double>, label int, node string, k1 string, n string, score string, vec string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, "x", "y") for r in rows], ROWS)


def crowded(seed, loose=0.12):
    """Vectors with a tight crowd, a loose crowd, copies and chains."""
    rng = np.random.default_rng(seed)
    noise = rng.normal(size=(300, 16))
    tight = rng.normal(size=16) + 0.02 * rng.normal(size=(150, 16))
    spread = rng.normal(size=16) + loose * rng.normal(size=(150, 16))
    chain = np.array([np.r_[np.cos(0.25 * k), np.sin(0.25 * k), np.zeros(14)] for k in range(12)])
    every = np.concatenate([noise, tight, spread, chain, np.repeat(noise[:1] * 3, 20, 0)])
    return every[rng.permutation(len(every))]


def plain_links(ids, vectors, least):
    flat = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    links = flat @ flat.T >= least
    np.fill_diagonal(links, False)
    part, before = ids.copy(), None
    while before is None or (part != before).any():
        before = part
        part = np.minimum(part, np.where(links, part[None, :], ids.max()).min(1))
    return {i: (int(n), int(c), bool(i == c)) for i, n, c in zip(ids.tolist(), links.sum(1), part)}


@pytest.mark.parametrize("cell, block", [(40, 30), (4_096, 4_096)])
def test_range_join_against_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(rangejoin, "CELL_ROWS", cell)
    monkeypatch.setattr(rangejoin, "BLOCK", block)
    vectors = crowded(cell)
    ids = np.arange(len(vectors)) * 3 + 1
    got = rangejoin.range_links(rows_of(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)])).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == plain_links(ids, vectors, 0.95)


def test_pivots_discard_and_crowds_are_not_compared(spark):
    vectors = crowded(3)
    pivots = rangejoin.pick(vectors, 20, 0.95)
    apart = rangejoin.unit(vectors) @ pivots.points.T
    assert (np.arccos(np.clip(apart.max(1), -1, 1)) <= pivots.reach / 2).sum() >= 150
    rows = spark.createDataFrame([(i, i, 1, v.tolist()) for i, v in enumerate(vectors)], "node bigint, k1 bigint, n bigint, vec array<double>")
    home = rangejoin.at_home(rows, pivots, 16)
    ends = {r["cell"]: (r["a"], r["b"]) for r in home.groupBy("cell").agg(F.min("far").alias("a"), F.max("far").alias("b")).collect()}
    inner, outer = (np.array([ends.get(k, (np.inf, -np.inf))[e] for k in range(20)]) for e in (0, 1))
    assert rangejoin.visitors(home, pivots, inner, outer, 16).count() < len(vectors) * 19 / 2 * 0.8


def test_range_join_odd_rows(spark):
    one = [1.0, 2.0, 0.0]
    rows = [(5, one, 0), (3, one, 1), (3, one, 1), (3, [9.0, 0.0, -1.0], 2), (8, [9.1, 0.0, -1.0], 2), (None, one, 0), (4, None, 0), (6, [], 0),
            (7, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 2.0], 0), (10, [float("nan"), 1.0, 1.0], 0), (11, [1.0, 2.0], 0), (12, [1e300, 2e300, 0.0], None)]
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rangejoin.range_links(rows_of(spark, rows)).collect()}
    alone = {(i, 0, i, True) for i in (4, 6, 7, 9, 10, 11)}
    assert got == {(5, 2, 3, False), (3, 2, 3, True), (3, 1, 3, True), (8, 1, 3, False), (12, 2, 3, False), (None, 0, None, False)} | alone
    assert rangejoin.range_links(rows_of(spark, [])).collect() == []
    assert [tuple(r) for r in rangejoin.range_links(rows_of(spark, [(1, None, 0)])).collect()] == [(1, 0, 1, True)]


def plain_runs(words):
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        k = 0
        while k < n - p:
            if words[k] != words[k + p]:
                k += 1
                continue
            e = k
            while e < n - p and words[e] == words[e + p]:
                e += 1
            if e - k >= p:
                found.setdefault((k, e + p), p)
            k = e
    return sorted(((s, e - s, p) for (s, e), p in found.items() if e - s >= max(12, 2 * p)), key=lambda r: (r[0], r[2]))


def made_text(rng):
    few = rng.choice([1, 2, 3, 40])
    kind, n = rng.random(), rng.choice([0, 1, 11, 12, 40, 150])
    noise = [str(rng.randrange(few)) for _ in range(n)]
    if kind < 0.3:
        return noise
    unit = [str(rng.randrange(few + 1)) for _ in range(rng.randrange(1, 6))]
    block = (unit * 60)[:rng.randrange(1, 120)]
    if kind < 0.6:  # runs beside each other, of one period or several
        return noise + block + (unit * 60)[:rng.randrange(1, 120)]
    return (block + [str(rng.randrange(4))] * rng.randrange(2)) * rng.randrange(1, 4) + noise


def test_runs_against_all_periods():
    rng = random.Random(11)
    for _ in range(60):
        texts = [made_text(rng) for _ in range(20)]
        assert periodic.texts_runs(texts) == [plain_runs(words) for words in texts]


def test_runs_that_lie_across_smaller_ones():
    """The first half is all of a small period, so no synchronising place lies in it."""
    words = "a b c".split() * 33 + ["a", "b"]
    assert (0, 202, 101) in periodic.texts_runs([words * 2])[0]
    assert periodic.texts_runs([words * 2])[0] == plain_runs(words * 2)


def test_synchronising_set_is_sparse_and_consistent():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1000, 4000)
    words[2000:2500] = words[500:1000]
    hashes = {1: periodic.mixed(words.astype(np.uint64), np.uint64(7))}
    for step in (1, 2, 4, 8, 16):
        hashes[2 * step] = periodic.joined(hashes[step], step)
    at, period = periodic.proposals(words, hashes, 16, periodic.Found())
    assert len(at) == 0  # the copies are too far apart for this scale
    least = periodic.window_minimum(hashes[16], 17)
    assert (least == np.array([hashes[16][k:k + 17].min() for k in range(4000)])).all()
    chosen = (least[:3900] == hashes[16][:3900]) | (least[:3900] == hashes[16][16:3916])
    assert chosen.mean() < 0.2 and (chosen[500:960] == chosen[2000:2460]).all()


def test_very_long_text_of_one_run():
    words = [f"w{k}" for k in range(5_000)] * 80
    assert periodic.texts_runs([words]) == [[(0, 400_000, 5_000)]]


def test_runs_query_digests(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts) and sum(r["n_runs"] > 0 for r in got.values()) > 5
    for doc_id, text in texts:
        words = queries.repeated_tail(doc_id, periodic.WORD.findall(text or ""))
        if len(words) > 700:
            continue
        runs = plain_runs(words)
        drop = {k for s, n, p in runs for k in range(s + p, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        row = got[doc_id]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        kept = " ".join(w for k, w in enumerate(words) if k not in drop)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_runs_odd_rows(spark, odd_docs, no_docs):
    got = periodic.periodic_runs(odd_docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and got.count() == odd_docs.count()
    rows = {(r["doc_id"], r["collapsed"]): r for r in got.collect()}
    assert rows[3, ""]["n_words"] == 0 and rows[4, ""]["runs"] == [] and rows[None, ""]["runs"] == []
    assert rows[10, "one\x1ftwo\xa0three\x85four"]["n_words"] == 1
    assert periodic.periodic_runs(no_docs).collect() == []
    doubled = spark.createDataFrame([("a", "x y " * 6 + "z"), ("a", "x y " * 6 + "z")], "doc_id string, text string")
    assert [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(doubled).collect()] == [
        ("a", [(0, 12, 2)], "x y z")] * 2


def plain_negatives(rows, positives=5, count=3):
    """``rows``: (id, label, whole components), distinct; an anchor's id is divisible by 5."""
    out = []
    for own, label, vec in rows:
        if own % 5:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(vec, v)), i, lab) for i, lab, v in rows if i != own or lab != label), key=lambda x: x[:2])
        for s, i, _ in [x for x in scored if x[2] == label and x[1] != own][:positives]:
            fits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:count]
            out += [(own, i, k, j, -s, -t) for k, (t, j, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, block", [(37, 11), (16_384, 16_384)])
def test_hard_negatives_against_all_rows(spark, monkeypatch, shard, block):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "BLOCK", block)
    rng = np.random.default_rng(shard)
    vectors = np.concatenate([rng.normal(size=(150, 7)), rng.normal(size=7) + 0.1 * rng.normal(size=(80, 7)), np.zeros((3, 7)), np.ones((9, 7))])
    labels = np.where(rng.random(len(vectors)) < 0.4, 1, rng.integers(0, 6, len(vectors)))
    frame = rows_of(spark, [(k, v.tolist(), int(y)) for k, (v, y) in enumerate(zip(vectors, labels))])
    got = negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0).collect()
    whole = [(k, int(y), [int(x) for x in np.floor(256 * v)]) for k, (v, y) in enumerate(zip(vectors, labels))]
    assert sorted(map(tuple, got)) == plain_negatives(whole)


def test_heap_visits_by_falling_bounds_and_stops_early():
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(30, 8)) * 100
    vectors = np.floor(np.repeat(middles, 40, 0) + rng.normal(size=(1200, 8)))
    index = negatives.Shard(negatives.fit(vectors), vectors, np.arange(1200), np.arange(1200) % 3)
    seen, scores = [], vectors @ vectors[7]
    for bound, begin, end in index.cells(vectors[7]):
        seen.append(bound)
        assert (index.vectors[begin:end] @ vectors[7] <= bound).all()
    assert seen == sorted(seen, reverse=True)
    visited = []
    plain = index.scores
    index.scores = lambda anchor, begin, end: visited.append((begin, end)) or plain(anchor, begin, end)
    best = index.best(vectors[7], 7, 1, 5)
    assert len(visited) < len(seen) / 2
    wanted = sorted(((-s, i) for i, s in enumerate(scores) if i % 3 == 1 and i != 7))[:5]
    assert best == [(int(-s), i) for s, i in wanted]


def test_hard_negatives_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.5], 2), (3, [1.0, 0.5], 2), (4, [0.5, 0.9], 2), (6, [0.75, 1.0], 3),
            (7, None, 1), (8, [1.0, None], 1), (9, [float("inf"), 1.0], 2), (None, [1.0, 1.0], 1), (11, [1.0], 2), (12, [1.0, 1.0], None), (13, [], 2)]
    got = sorted(map(tuple, negatives.hard_negatives(rows_of(spark, rows), F.col("vec_id") % 5 == 0).collect()))
    whole = [(0, 1, [256, 256]), (1, 1, [256, 256]), (2, 2, [256, 128]), (3, 2, [256, 128]), (4, 2, [128, 230]), (6, 3, [192, 256])]
    assert got == plain_negatives(whole) and len(got) == 3
    assert negatives.hard_negatives(rows_of(spark, []), F.col("vec_id") % 5 == 0).collect() == []
    huge = [(0, [1e200, 1.0], 1), (1, [1e200, 1.0], 1), (2, [9e199, 1.0], 2), (3, [2e11, 3.0], 2)]
    assert negatives.hard_negatives(rows_of(spark, huge), F.col("vec_id") % 5 == 0).count() == 0  # equal beyond 10**37, so above the window
    large = [(0, [3e8, 1.0], 1), (1, [3e8, 7.0], 1), (2, [2.5e8, 1.0], 2)]
    a, b, c = (np.array([int(256 * x) for x in v], object) for _, v, _ in large)
    assert [tuple(r)[4:] for r in negatives.hard_negatives(rows_of(spark, large), F.col("vec_id") % 5 == 0).collect()] == [
        (min(int(a @ b), 2**63 - 1), min(int(a @ c), 2**63 - 1))]


def test_line_dedup_is_linear_in_the_lines(spark):
    """A book of 100,000 lines, most of them shared, as one document."""
    import time

    from urlwarden.llm.linededup import without_shared_lines

    lines = [f"shared line {k}" for k in range(100_000)]
    docs = [(0, "first\n" + "\n".join(lines), "s0")] + [(k, "\n".join(lines[k::6]), f"s{k}") for k in range(1, 6)] + [
        (9, "\n".join([*lines[:90_000], "own line", *lines[90_000:]]), "s9")] + [(k, None, None) for k in range(10, 40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    started = time.perf_counter()
    got = {r["doc_id"]: r for r in without_shared_lines(frame, min_sites=3).collect()}
    assert time.perf_counter() - started < 40
    assert len(got) == len(docs) and got[0]["n_removed"] == 0 and got[20]["text"] is None
    stays = [line for k, line in enumerate(lines) if k % 6 == 0]  # only two sites have these
    kept = {*stays, "own line"}
    assert got[9]["text"].split("\n") == [x for x in [*lines[:90_000], "own line", *lines[90_000:]] if x in kept]
    assert got[9]["n_lines"] == 100_001 and got[9]["n_removed"] == 100_000 - len(stays)


def test_pivot_tables_discard_pairs_before_and_after_sorting():
    from urlwarden.llm import simhash

    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, (40, 200), dtype=np.uint64) | (rng.integers(0, 2, (40, 200), dtype=np.uint64) << np.uint64(63))
    prints[:, 1] = prints[:, 0] ^ np.uint64(1 << 5)
    prints[:, 3] = prints[:, 2] ^ np.uint64((1 << 63) | 1)
    pivots = simhash.references()
    first = np.sort(np.bitwise_count(prints ^ pivots[0]).astype(int), axis=1)
    paired = sum((first[:, lag:] - first[:, :-lag] <= 2).sum() for lag in range(1, 200))
    order = np.argsort(np.bitwise_count(prints ^ pivots[0]), axis=1, kind="stable")
    rows = np.take_along_axis(prints, order, 1)
    left = sum(len(b) for b, _, _ in simhash.survivors(np.bitwise_count(rows[..., None] ^ pivots).astype(np.int8), 2))
    every = 40 * 200 * 199 // 2
    assert paired < every / 2 and left < every / 2000  # the sort alone halves them, the table leaves next to none
    found = set(map(frozenset, zip(*map(np.ndarray.tolist, simhash.links_of(prints, pivots, 2)))))
    want = {frozenset((int(a), int(b))) for row in prints for i, a in enumerate(row) for b in row[i + 1:] if (int(a) ^ int(b)).bit_count() <= 2}
    assert found == want and len(want) >= 80
