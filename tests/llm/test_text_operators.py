"""Fingerprints, line removal, SimHash, packing and pipeline against brute force."""

import collections
import random
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from urlwarden.llm import linededup, quality, simhash, spotsigs, subwords
from urlwarden.llm.components import components
from urlwarden.llm.packing import pack, sequences
from urlwarden.llm.queries import BYTE_BPE, QUERIES, SQL
from urlwarden.llm.subwords import Subwords


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- fingerprints

def chains(text):
    parts = []
    for word in regex.findall(r"[\p{L}\p{N}]+", text.lower()):
        if word in spotsigs.ANCHORS:
            parts.append((word, []))
        elif parts:
            parts[-1][1].append(word)
    parts = [p for p in parts if p[1]]
    found = {(a, *(c + (parts[i + 1][1] if i + 1 < len(parts) else []))[:2]) for i, (a, c) in enumerate(parts)}
    return found or {tuple(regex.findall(r"[\p{L}\p{N}]+", text.lower()))}


def check_compared(docs, spark):
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in rows_of(docs)), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = collections.defaultdict(list)
    for row in rows_of(spotsigs.compared(docs)):
        got[row["doc_id"]].append(row)
    assert sum(map(len, got.values())) == len(ordered)
    return ordered, got


def test_spotsigs_against_brute_force(spark, documents):
    ordered, got = check_compared(documents, spark)
    prints = {}
    for k, (doc, text) in enumerate(ordered):
        (row,), following = got[doc], ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = chains(text), chains(edited), chains(following)
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row["near_edited"] == pytest.approx(len(own & other) / len(own | other))
        assert row["near_next"] == pytest.approx(len(own & after) / len(own | after))
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]


def test_spotsigs_odd_rows(spark, odd_docs, no_docs):
    ordered, got = check_compared(odd_docs, spark)
    assert got[3][0]["fingerprint"] == got[4][0]["fingerprint"] and got[3][0]["n_chars"] == 0
    assert got[1][0]["fingerprint"] == got[2][0]["fingerprint"] == got[2][1]["fingerprint"]
    assert all(0 <= r["near_next"] <= 1 for rows in got.values() for r in rows)
    assert rows_of(spotsigs.compared(no_docs)) == []
    single = spark.createDataFrame([(5, "the word here")], "doc_id bigint, text string")
    assert rows_of(spotsigs.compared(single))[0]["near_next"] == 1.0


def test_spans_and_their_borders_do_not_matter(spark, documents):
    """Any number of spans gives the same follower."""
    few = {(r["id"], r["next_text"]) for r in rows_of(spotsigs.with_next(documents, count=2))}
    many = {(r["id"], r["next_text"]) for r in rows_of(spotsigs.with_next(documents, count=150))}
    assert few == many


# ---------------------------------------------------------------- lines

def test_line_dedup_sql(spark, sf_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = {r[0]: r[1:] for r in db.execute(SQL["op9_line_dedup"]).fetchall()}
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in rows_of(QUERIES["op9_line_dedup"](spark, sf_dir))}
    assert got == want


def test_line_dedup_odd_rows(odd_docs, no_docs):
    cleaned = linededup.without_shared_lines(odd_docs, min_sites=4)
    assert cleaned.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    rows = collections.defaultdict(list)
    for row in rows_of(cleaned):
        rows[row["doc_id"]].append(row)
    # The nameless document comes first and keeps the line; edges don't count in comparing.
    assert {r["text"] for r in rows[None]} == {None, "nobody's text\nshared line here"}
    assert [r["text"] for r in rows[2]] == ["The cat of the house\nthe end"] * 2
    assert rows[7][0]["text"] == "\n" and rows[7][0]["n_removed"] == 2
    assert rows[6][0]["text"].startswith("ÀÉ") and rows[8][0]["text"] == "\n\n" and rows[4][0]["text"] == ""
    assert rows_of(linededup.without_shared_lines(no_docs)) == []


def test_lines_near_the_threshold_are_counted_exactly(spark):
    """Spreads around the threshold, far more than a sketch keeps apart by itself."""
    rows = [(site * 100 + n, f"line {n}", f"s{site}") for n in range(56, 65) for site in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    cleaned = rows_of(linededup.without_shared_lines(docs, min_sites=60))
    kept = collections.Counter(r["doc_id"] % 100 for r in cleaned if r["text"])
    assert kept == {n: n if n < 60 else 1 for n in range(56, 65)}


# ---------------------------------------------------------------- SimHash

def print_of(text, words_each=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + words_each]) for i in range(max(1, len(words) - words_each + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def components_of(prints, bits=2):
    keys, above = sorted(prints, key=lambda k: (k is None, k)), {}
    values = np.array([prints[k] for k in keys], np.uint64)
    label = list(range(len(keys)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= bits):
            a, b = sorted((top(i), top(i + 1 + int(j))))
            label[b] = a
    return {k: keys[top(i)] for i, k in enumerate(keys)}


def test_simhash_against_brute_force(spark, documents, sf_dir):
    prints = {r["doc_id"]: print_of(r["text"]) for r in rows_of(documents)}
    groups = components_of(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(QUERIES["op3_simhash"](spark, sf_dir))}
    assert got == {k: (f"{prints[k]:016x}", groups[k]) for k in prints}


def test_simhash_odd_rows(odd_docs, no_docs):
    got = collections.defaultdict(set)
    for row in rows_of(simhash.near_copies(odd_docs)):
        got[row["doc_id"]].add((row["fingerprint"] % 2**64, row["component_id"]))
    for row in rows_of(odd_docs):
        assert print_of(row["text"]) in {f for f, _ in got[row["doc_id"]]}
    assert {c for _, c in got[2]} == {1} and (0, 3) in got[None] and got[4] == {(0, 3)}
    kept = rows_of(simhash.one_of_each(odd_docs))
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["1", "3", "None", "5", "6", "7", "9", "10"])
    assert list(kept[0]) == odd_docs.columns
    assert rows_of(simhash.near_copies(no_docs)) == [] and rows_of(simhash.one_of_each(no_docs)) == []


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Thousands of fingerprints in one bucket, chained by two bits at a time, and strangers among them."""
    random = np.random.default_rng(1)
    base = int(random.integers(1, 1 << 63))
    low = [base ^ int(x) for x in random.choice(1 << 16, 1500, replace=False)]
    far = [int(x) for x in random.integers(0, 1 << 63, 500)]
    prints = sorted({*low, *far})
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    monkeypatch.setattr(simhash, "CROWD", 64)
    dealt = simhash.buckets(frame, 2)
    assert dealt.groupBy("mask", "value").count().agg(F.max("count")).first()[0] <= 256
    links = simhash.linked(dealt, 2)
    assert all((r["a"] ^ r["b"]).bit_count() <= 2 for r in rows_of(links))
    got = {r["node"]: r["component"] for r in rows_of(components(links))}
    want = components_of({p: p for p in prints})
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)] + [(5, 5)]
    found = rows_of(components(spark.createDataFrame(links, "a bigint, b bigint")))
    assert len(found) == 201 + 50 + 7
    assert all(r["component"] == (0 if r["node"] <= 200 else 1000 if r["node"] < 2000 else 2000) for r in found)
    assert rows_of(components(spark.createDataFrame([], "a bigint, b bigint"))) == []


# ---------------------------------------------------------------- subwords and packing

def test_words_encode_like_whole_texts(documents):
    encoder, plain = Subwords(BYTE_BPE), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r["text"] for r in rows_of(documents)] + [
        "it's we've 'sx  a   b\n\n c\n\nd \n e", "  lead", "tail  ", "\n", "", "a\n \n b", "x'll 12ab ab12 !! ?'s 'sé é'", "<|endoftext|> b",
        "日本 a", "a\tb\r\nc", "é" * 5 + " à1", "don't I'm you're", "a　b   c", "x\xa0 y  \x85z", "²³ ½ ª º µ", " " * 3000 + "x"]
    want = [np.array(e.ids, encoder.dtype).tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    encoder.forget()
    assert encoder.encode(reversed(texts)) == want[::-1]


def test_cuts_of_odd_texts(monkeypatch):
    """Contractions, blanks and line ends in any order; long texts in parts; cuts forgotten and learned again."""
    encoder, plain, rng = Subwords(BYTE_BPE), Tokenizer.from_file(BYTE_BPE), random.Random(2)
    bits = ["a", "b", " ", "  ", "\n", "\n\n", "'", "'s", "'re", "'ll", "'ve", "'x", "3", "42", "!", "?!", "é", "×", "÷", "ß", "À", "don't", " it's", "''s", "\"", "-", "t's"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(1500)]
    want = [np.array(e.ids, encoder.dtype).tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    monkeypatch.setattr(subwords, "GROUP", 70)
    monkeypatch.setattr(subwords, "KEPT_CUTS", 50)
    long = " ".join(texts)
    assert len(list(subwords.parts(long))) > 100
    assert encoder.encode([long, *texts]) == [np.array(plain.encode(long, add_special_tokens=False).ids, encoder.dtype).tobytes(), *want]
    assert encoder.encode([]) == []


def check_pieces(docs, pieces):
    plain = Tokenizer.from_file(BYTE_BPE)
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows_of(docs))
    want = collections.Counter(
        (None if none else k, np.array([*e.ids, 0], "<u4").tobytes()) for (none, k, _), e in zip(texts, plain.encode_batch([t for *_, t in texts], add_special_tokens=False)))
    places, whole, open_piece = {}, collections.Counter(), {}
    pieces = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    row = b""
    for k, p in enumerate(pieces):
        assert p["length"] * 4 == len(p["ids"]) > 0 and p["offset"] + p["length"] <= 1024
        assert p["offset"] == places.get(p["sequence_id"], 0)
        places[p["sequence_id"]] = p["offset"] + p["length"]
        row = (b"" if p["opens"] else row)
        assert p["start"] * 4 == len(row)
        row += p["ids"]
        if p["closes"]:
            assert len(row) == 4 * p["doc_tokens"]
            whole[p["doc_id"], row] += 1
    assert whole == want
    assert sorted(places) == list(range(len(places)))
    assert all(n == 1024 for k, n in places.items() if k != len(places) - 1)


def test_packing_keeps_every_id_once(documents):
    check_pieces(documents, rows_of(pack(documents, BYTE_BPE)))


def test_packing_odd_rows(odd_docs, no_docs):
    pieces = pack(odd_docs, BYTE_BPE)
    check_pieces(odd_docs, rows_of(pieces))
    for row in rows_of(sequences(pieces)):
        n = row["tokens"]
        assert len(row["ids"]) == 4 * (n if n & (n - 1) == 0 else 1024)
    assert rows_of(pack(no_docs, BYTE_BPE)) == []


def test_packing_query_digests(spark, sf_dir, documents):
    raw = {(r["doc_id"], r["start"]): r["ids"] for r in rows_of(pack(documents, BYTE_BPE))}
    for row in rows_of(QUERIES["op6_packing"](spark, sf_dir)):
        assert row["ids_crc32"] == zlib.crc32(raw[row["doc_id"], row["start"]])


# ---------------------------------------------------------------- quality and pipeline

def test_quality_held_out(spark):
    rows = QUERIES["op2_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in judged) / len(judged) > 0.95
    assert all(p for p, q in judged if q)


def test_quality_blocks_and_bags_agree(monkeypatch):
    """Blocks change nothing but at words that they cut."""
    text = ("Some words, some words again. " * 40).encode()
    whole = quality.features(text)
    assert sum(map(len, whole[:3])) == 3 * len(text) - 3
    monkeypatch.setattr(quality, "BLOCK", 30)
    parts = quality.features(text)
    assert sorted(np.concatenate([p for p in parts]).tolist()) != [] and len(np.concatenate(whole)) - len(np.concatenate(parts)) < 100


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (9, None), (77, 0)], "doc_id bigint, quality int")
    model = quality.fit(odd_docs, labels)
    rows = rows_of(quality.scored(odd_docs, model))
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert rows_of(quality.scored(no_docs, model)) == []
    unlearned = quality.fit(no_docs, labels.limit(0))
    assert {r["score"] for r in rows_of(quality.scored(odd_docs, unlearned))} == {0.5}


def test_pipeline_stages(spark, sf_dir, documents, tmp_path):
    docs, columns = documents, documents.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = rows_of(docs)
        if k < 3:
            assert docs.columns == columns and {f.dataType for f in docs.schema} == {f.dataType for f in documents.schema}
    kept = {r["doc_id"] for r in seen["quality"]}
    assert all(k in kept for k, q in labels.items() if q == 1) and any(k not in kept for k in labels)
    assert {r["doc_id"] for r in seen["line_dedup"]} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    groups = components_of({r["doc_id"]: print_of(r["text"]) for r in seen["line_dedup"]})
    assert {r["doc_id"] for r in seen["simhash"]} == set(groups.values())
    assert {r["doc_id"] for r in seen["packing"]} == set(groups.values())


def linked_sets(docs, members, links, anchors, least):
    """Pairs of ids whose sets are near, by brute force and by the join; equal sets by their classes."""
    marks = {r["doc_id"]: set(r["signatures"]) for r in docs.select("doc_id", spotsigs.signatures(F.col("text"), anchors).alias("signatures")).collect()}
    want = {(a, b) for a in marks for b in marks if a < b and len(marks[a] & marks[b]) >= least * len(marks[a] | marks[b]) - 1e-9}
    by_class = {}
    for r in members.collect():
        by_class.setdefault(r["class"], []).append(r["doc_id"])
    found = [(r["class_a"], r["class_b"]) for r in links.collect()]
    assert len(found) == len(set(map(frozenset, found)))
    got = {(a, b) for a, b in ((min(x, y), max(x, y)) for k, m in found for x in by_class[k] for y in by_class[m])}
    return want, got | {(a, b) for ids in by_class.values() for a in ids for b in ids if a < b}


@pytest.mark.parametrize("least,crowd", [(0.8, 512), (0.5, 2), (0.8, 3)])
def test_near_sets_against_brute_force(spark, least, crowd):
    """Near copies of texts of no language; words of each kind; crowded signatures split into blocks."""
    draw = random.Random(int(least * 10) + crowd)
    common, rare = ["ab", "cu", "ni", "pe", "si", "o"], [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(25):
        words = [draw.choice(common if draw.random() < 0.4 else rare) for _ in range(draw.randint(1, 160))]
        for _ in range(draw.randint(1, 6)):
            texts.append(" ".join(w if draw.random() > 0.02 else draw.choice(rare) for w in words))
    texts += ["", None, "", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    anchors = spotsigs.corpus_anchors(docs, 6)
    assert set(anchors) == set(common)
    members, links = spotsigs.near_sets(docs, least, anchors, crowd=crowd)
    want, got = linked_sets(docs, members, links, anchors, least)
    assert got == want and len(want) > 20


def test_near_sets_odd_rows(spark, odd_docs, no_docs):
    members, links = spotsigs.near_sets(odd_docs)
    rows = members.collect()
    assert members.columns == ["doc_id", "class"] and len(rows) == odd_docs.count()
    classes = {r["doc_id"]: r["class"] for r in rows if r["doc_id"] is not None}
    assert classes[1] == classes[2] and classes[3] == classes[4] == classes[8]
    assert all(0.8 <= r["similarity"] < 1 for r in links.collect())
    members, links = spotsigs.near_sets(no_docs)
    assert members.count() == links.count() == 0


def test_near_sets_stay_native(spark, documents):
    _, links = spotsigs.near_sets(documents)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
