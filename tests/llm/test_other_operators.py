"""Neighbours, segmentations, HTML, WARC and language-model scores against brute force."""

import collections
import hashlib
import html
import itertools
import math
import random
import re
import tracemalloc
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from urlwarden.llm import attention, lm, neighbours, segment, warc
from urlwarden.llm.htmltext import page_text, visible_text
from urlwarden.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- neighbours

def nearest(rows, queries, count=5):
    found = {}
    for k in queries:
        q = np.array(rows[k], float)
        scored = []
        for j, v in rows.items():
            if j != k:
                v = np.array(v, float)
                a, b = q / np.abs(q).max(), v / np.abs(v).max()
                scored.append((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), j))
        found[k] = sorted(scored)[:count]
    return found


def test_neighbours_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    want = nearest(vectors, [k for k in vectors if k % 50 == 0])
    got = collections.defaultdict(list)
    for r in sorted(rows_of(QUERIES["op4_neighbours"](spark, sf_dir)), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({j for _, j in want[k]} & {j for j, _ in got[k]}) for k in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {(k, j): -s for k in want for s, j in want[k]}
    assert all(s == pytest.approx(exact[k, j], abs=1e-12) for k, some in got.items() for j, s in some if (k, j) in exact)


def test_neighbours_odd_rows(spark):
    """Hot vectors, ties, rows twice, what takes no part; with few vectors all are found."""
    same, other = [1.0, 2.0, 0.0], [0.0, -1.0, 3.0]
    rows = [(k, same) for k in range(0, 400)] + [(k, other) for k in range(400, 420)] + [(500, [1e-200, 0.0, 0.0]), (550, [3e200, 1.0, 0.0])]
    bad = [(600, None), (650, []), (700, [0.0, 0.0, 0.0]), (750, [1.0, None, 2.0]), (800, [float("nan"), 1.0, 1.0]),
           (850, [float("inf"), 1.0, 1.0]), (900, [1.0, 2.0]), (None, same)]
    frame = spark.createDataFrame([(k, v, "x") for k, v in rows + bad + rows[:50]], "vec_id bigint, embedding array<double>, k1 string")
    want = nearest(dict(rows), [k for k, _ in rows if k % 50 == 0])
    got = collections.defaultdict(list)
    for r in sorted(rows_of(neighbours.neighbours(frame, F.col("vec_id") % 50 == 0)), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert {k: [(n + 1, j) for n, (_, j) in enumerate(some)] for k, some in want.items()} == {k: [x[:2] for x in some] for k, some in got.items()}
    two = spark.createDataFrame([(0, same), (50, other)], "vec_id bigint, embedding array<double>")
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in rows_of(neighbours.neighbours(two, F.lit(True)))) == [(0, 1, 50), (50, 1, 0)]
    assert rows_of(neighbours.neighbours(frame.limit(0), F.lit(True))) == []


def test_shards_and_blocks_find_the_same(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = {tuple(r) for r in neighbours.neighbours(vectors, F.col("vec_id") % 3 == 0).collect()}
    monkeypatch.setattr(neighbours, "SHARD", 40)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    assert {tuple(r) for r in neighbours.neighbours(vectors, F.col("vec_id") % 3 == 0).collect()} == whole


def test_neighbours_recall_with_hundreds_of_lists(spark, tmp_path, monkeypatch):
    """Vectors without clusters, far more lists than are read at least."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 25)
    points = np.random.default_rng(8).standard_normal((20_000, 64))
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, points.size + 1, 64), pa.int32()), pa.array(points.ravel()))
    pq.write_table(pa.table({"vec_id": pa.array(range(len(points))), "embedding": flat}), tmp_path / "points.parquet")
    frame = spark.read.parquet(str(tmp_path / "points.parquet"))
    queries = np.arange(0, len(points), 100)
    found = collections.defaultdict(set)
    for r in neighbours.neighbours(frame, F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    alike = neighbours.unit(points[queries]) @ neighbours.unit(points).T
    alike[np.arange(len(queries)), queries] = -2
    want = np.argsort(-alike, axis=1)[:, :5]
    hits = sum(len(found[int(q)] & set(some.tolist())) for q, some in zip(queries, want))
    assert hits / want.size >= 0.97


def test_neighbours_reads_on_until_there_are_enough(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    few = neighbours.neighbours(vectors, F.col("vec_id") % 70 == 0, count=400, probes=1, ratio=1.0, recall=0.0)
    assert {r["count"] for r in few.groupBy("query_id").count().collect()} == {400}


def test_graph_search_finds_near_centroids():
    points = np.random.default_rng(0).standard_normal((4000, 16))
    index = neighbours.build(points, 300)
    queries = neighbours.unit(points[:200])
    found, near = index.search(queries)
    best = (queries @ index.centroids.T).argmax(1)
    assert (found[:, 0] == best).mean() > 0.97 and (np.diff(near, axis=1) >= -1e-12).all()


def test_graph_search_comes_by_a_part_of_the_centroids():
    random = np.random.default_rng(1)
    points = np.repeat(random.standard_normal((60, 16)), 100, 0) + 0.3 * random.standard_normal((6000, 16))
    index = neighbours.build(points, 3000)
    queries = neighbours.unit(points[::60])
    sight = index.walk(queries, 64)
    assert 64 <= np.isfinite(sight).sum(1).min() and np.isfinite(sight).mean() < 0.4
    true = queries @ index.centroids.T
    assert np.allclose(sight[np.isfinite(sight)], true[np.isfinite(sight)])
    found, want = index.search(queries)[0][:, :20], np.argsort(-true, axis=1)[:, :20]
    assert np.mean([len({*a} & {*b}) for a, b in zip(found.tolist(), want.tolist())]) / 20 > 0.95
    assert np.isfinite(index.walk(queries[:20], 3000)).mean() > 0.99  # a beam of all lists goes wherever the graph leads


# ---------------------------------------------------------------- segmentations

def all_segmentations(words):
    def paths(edges, at):
        if at == len(edges):
            yield (), 0.0
            return
        for end, ids, share in edges[at]:
            for rest, total in paths(edges, end):
                yield ids + rest, share + total
    for combination in itertools.product(*(list(paths(w, 0)) for w in words)):
        yield sum((ids for ids, _ in combination), ()), sum(total for _, total in combination)


def test_segmentation_shares_and_samples():
    vocabulary = segment.Pieces(PIECE_BPE)
    words = vocabulary.lattices("the cat is")
    shares = dict(all_segmentations(words))
    assert sum(map(math.exp, shares.values())) == pytest.approx(1)
    everything = segment.sampled(words, 10**6, random.Random(0))
    assert {tuple(ids): pytest.approx(share) for share, _, ids in everything} == shares
    assert all(a[1] >= b[1] for a, b in zip(everything, everything[1:]))
    first, weights, trials = collections.Counter(), 0.0, 6000
    for n in range(trials):
        found = segment.sampled(words, 4, random.Random(n))
        first[tuple(found[0][2])] += 1
        weights += sum(math.exp(s) / -math.expm1(-math.exp(s - found[3][1])) for s, _, _ in found[:3])
    for ids, share in sorted(shares.items(), key=lambda x: -x[1])[:4]:
        assert first[ids] / trials == pytest.approx(math.exp(share), abs=0.03)
    assert weights / trials == pytest.approx(1, abs=0.03)  # inverse inclusion weights are unbiased


def test_segmentations_round_trip(spark, sf_dir):
    rows = rows_of(QUERIES["op5_segmentations"](spark, sf_dir))
    assert all(r["round_trip"] for r in rows) and all(0 < r["inclusion"] <= 1 for r in rows)
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[r["conv_id"], r["turn"]].add(tuple(r["ids"]))
    assert sum(map(len, by_text.values())) == len(rows)
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert len(by_text) == talks.count()
    model = segment.Pieces(PIECE_BPE).model
    texts = {(r.conv_id, r.turn): r.text for r in talks.collect()}
    assert all(model.decode(list(ids)) == texts[key] for key, some in itertools.islice(by_text.items(), 100) for ids in some)


def test_segmentations_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").distinct().count()
    rows = rows_of(QUERIES["op5_segmentations_documents"](spark, sf_dir))
    assert len({r["doc_id"] for r in rows}) == docs and all(0 <= r["inclusion"] <= 1 for r in rows)  # of long texts too small for a double
    assert sum(r["round_trip"] for r in rows) > 0.9 * len(rows)


def test_long_texts_keep_few_alternatives():
    words = segment.Pieces(PIECE_BPE).lattices("understanding the segmentations " * 2000)
    tracemalloc.start()
    found = segment.sampled(words, 4, random.Random(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 4 and peak < 20 * sum(len(ids) for _, _, ids in found) * 8


def test_segmentations_odd_rows(spark, odd_docs, no_docs):
    rows = rows_of(segment.sample_segmentations(odd_docs, PIECE_BPE, ["doc_id", "source"]))
    texts = collections.defaultdict(set)
    for r in rows_of(odd_docs):
        texts[r["doc_id"], r["source"]].add(r["text"] or "")
    vocabulary = segment.Pieces(PIECE_BPE)
    for r in rows:
        assert vocabulary.decode(r["ids"]) in texts[r["doc_id"], r["source"]]
    empty = [r for r in rows if r["doc_id"] == 4]
    assert [(r["ids"], r["inclusion"], r["sample"]) for r in empty] == [([], 1.0, 1)]
    again = rows_of(segment.sample_segmentations(odd_docs.repartition(5), PIECE_BPE, ["doc_id", "source"]))
    assert sorted(again, key=str) == sorted(rows, key=str)
    assert rows_of(segment.sample_segmentations(no_docs, PIECE_BPE, ["doc_id"])) == []
    back = odd_docs.select(segment.decoded(F.lit(None).cast("array<int>"), PIECE_BPE).alias("t"))
    assert {r["t"] for r in rows_of(back)} == {None}


# ---------------------------------------------------------------- HTML

class Words(HTMLParser):
    """Visible words of a page whose tags are all closed or void."""

    def __init__(self):
        super().__init__()
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style", "title"):
            self.depth += 1
        self.parts.append("" if tag in ("b", "i", "a", "span", "em", "strong") else " ")

    def handle_endtag(self, tag):
        if tag in ("head", "script", "style", "title"):
            self.depth -= 1
        self.parts.append("" if tag in ("b", "i", "a", "span", "em", "strong") else " ")

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def test_html_words_of_all_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in rows_of(QUERIES["op7_html_text"](spark, sf_dir))}
    assert set(got) == set(pages)
    for key, page in pages.items():
        parser = Words()
        parser.feed(page)
        parser.close()
        want = "".join(parser.parts).split()
        assert [w for w in got[key].split() if w != "-"] == [w for w in want if w != "-"], key


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b <b>c</b>d<br>e", "a\n\nb cd\ne"),
    ("<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>after", "- x\n- y\n  3. q\n  4. r\n\nafter"),
    ("<table><tr><td>ab<td>c<tr><td>d<td>ee<td colspan=2>f</table>z", "ab  c\nd   ee  f\n\nz"),
    ("<table><caption>Cap</caption><tr><th>Name<th>N</tr><tr><td rowspan=2>long cell<td>1<tr><td>2</table>",
     "Cap\nName       N\nlong cell  1\n           2"),
    ("<div hidden>x</div><p style='color:red; display : none'>no<p>yes &amp; &lt;ok&gt; &eacute;<script>'</p>'</script> on<!-- c --> end",
     "yes & <ok> é on end"),
    ("<pre>\n a\n  b</pre>t<details><summary>S</summary>no</details><blockquote>q<p>r</blockquote>", " a\n  b\n\nt\nS\n\n  q\n\n  r"),
    ("<a title='x>y'>k</a> <i>l</i>m", "k lm"), ("a < b and c <3 <p>x</p", "a < b and c <3\n\nx"), ("<td>lone<td>cell", "lone cell"),
    ("<head><title>t</title><body>b", "b"), ("<title>x</title>y", "y"), ("<p class=hidden>s</p><input type=hidden value=v>", "s"),
    ("<dl><dt>t<dd>d<dd>e</dl>", "t\n  d\n  e"), ("x<!-- open <p>y</p>", "x"), ("plain  text", "plain text"), ("", ""),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<ul><li><p>a<p>b</ul>", "- a\n\n  b"),
])
def test_html_layout(page, text):
    assert page_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td>a</td></tr>Note</table>", "Note\na"), ("<table><tr><td>a</td></tr><p>Note</p></table>", "Note\n\na"),
    ("<table><tbody><div>text</div><tr><td>a</table>", "text\na"), ("<table><thead hidden>no<tr><td>x</thead><tr><td>a</table>", "a"),
    ("a <svg><title>t</title><rect/><text>in <tspan>image</tspan></text><defs><text>no</text></defs><title/><text>two</text></svg> b", "a in image two b"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> c", "x=1 c"), ("<svg><path d='M0'><p>out", "out"),
    ("<div>" * 300 + "a<script>no</script><style>no</style><div hidden><div>no</div>no</div>b", "ab"),
])
def test_html_strays_images_and_depth(page, text):
    assert page_text(page) == text


def test_html_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "<p>x"), (2, "<table>" * 500 + "<td>" * 500 + "x"), (2, html.escape("<b>") * 3)]
    frame = spark.createDataFrame([(k, h, "t") for k, h in rows], "page_id bigint, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in rows_of(visible_text(frame))), key=str)
    assert got == sorted([(1, None, 0), (1, "", 0), (None, "x", 1), (2, "x", 1), (2, "<b><b><b>", 9)], key=str)
    assert rows_of(visible_text(frame.limit(0))) == []


# ---------------------------------------------------------------- WARC

def expected_records(pages):
    large = collections.defaultdict(list)
    for page, body in pages:
        if len(body) >= 1000:
            large[body].append(page)
    for page, body in pages:
        kept = max((k for k in large[body] if k is not None), default=None) if body in large else page
        revisit = kept is not None and page != kept
        yield page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", kept if revisit else None


def test_warc_round_trip(spark, sf_dir):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    rows = rows_of(QUERIES["op8_warc"](spark, sf_dir))
    assert sorted(tuple(r.values())[:5] for r in rows) == sorted(expected_records(pages))


def test_warc_odd_rows(spark, tmp_path, monkeypatch):
    """Copies, null ids and payloads, payloads with line ends and separators of records, many small archives."""
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    large, bytes_ = "x\r\n\r\n" * 400, "\x00\x01\r\n\r\nWARC/1.1\r\n" * 90
    rows = [(k, "http://a.example/p?q#f", large) for k in range(40)] + [(k, f"http://www.b.example/{k}", bytes_) for k in (50, 51, 51, None)]
    rows += [(60, None, None), (61, "", ""), (62, "https://x y\n/é", "é" * 700), (None, "u", "short"), (None, "u", large), (63, "u", "short"), (64, "u", "short")]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, place string")
    index = rows_of(warc.archived(frame))
    got = sorted(((r["page_id"] and int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
                   r["refers_page"] and int(r["refers_page"])) for r in index), key=str)
    assert got == sorted(expected_records([(k, (h or "").encode()) for k, _, h in rows]), key=str)
    ordered = sorted(index, key=lambda r: r["place"])
    keys = [(r["url_key"], r["date"], r["record_id"]) for r in ordered]
    assert keys == sorted(keys) and [r["place"] for r in ordered] == list(range(len(rows)))
    assert rows_of(warc.archived(frame.limit(0))) == []
    folder = str(tmp_path / "warc")
    warc.write_archives(frame, folder)
    entry = rows_of(warc.read_archives(spark, folder))[0]
    data = open(entry["file"].removeprefix("file:"), "rb").read()[entry["offset"]:entry["offset"] + entry["length"]]
    assert zlib.decompress(data, 31).startswith(b"WARC/1.1\r\n")


def test_ranges_give_one_order(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder)
    index = warc.read_archives(spark, folder)
    one = {(r["place"], r["record_id"]) for r in rows_of(warc.histories(index))}
    many = {(r["place"], r["record_id"]) for r in rows_of(warc.histories(index, range_rows=5))}
    assert one == many


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(runs):
    draw = random.Random(runs)
    parts = [sorted(draw.choices(range(20), k=draw.randrange(12))) for _ in range(runs)]
    assert list(warc.merged(parts)) == sorted(itertools.chain(*parts))


# ---------------------------------------------------------------- language model

def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def check_counts(docs, rows, training):
    counts = collections.Counter(t for d in docs if training(d["doc_id"]) for t in tokens_of(d["text"]))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(d["doc_id"]), len(t), sum(counts[x] > 0 for x in t), total, round(sum(
        math.log10((counts[x] + 1) / (total + distinct + 1)) for x in t), 5)) for d in docs for t in [tokens_of(d["text"])])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want


def test_lm_counts_and_held_out_gain(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = rows_of(QUERIES["op10_lm_scoring"](spark, sf_dir))
    docs = rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    check_counts(docs, rows, lambda k: zlib.crc32(str(k).encode()) % 7 != 2)
    held = [r for r in rows if r["held_out"]]
    assert all(r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_odd_rows(spark, odd_docs, no_docs):
    rows = rows_of(lm.lm_scores(odd_docs, BYTE_BPE, F.col("doc_id") < 9, top=20, sample_docs=3, windows=50))
    check_counts(rows_of(odd_docs), rows, lambda k: k is not None and k < 9)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1
    unlearned = rows_of(lm.lm_scores(odd_docs, BYTE_BPE, F.lit(False)))
    assert all(r["train_tokens"] == 0 == r["n_known"] and np.isfinite(r["score"]) for r in unlearned)
    assert rows_of(lm.lm_scores(no_docs, BYTE_BPE, F.lit(True))) == []


def test_lm_scores_do_not_depend_on_the_words_that_travel(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few, many = ({r["doc_id"]: r["score"] for r in rows_of(lm.lm_scores(docs, BYTE_BPE, F.col("doc_id") % 7 != 2, top=top))} for top in (10, 200_000))
    assert few == {k: pytest.approx(v, rel=1e-6) for k, v in many.items()}


def test_lm_learns_from_documents_outside_the_sample(spark, monkeypatch):
    """A model begun on a few windows gets better on all documents by the pass over them."""
    begun, in_one_task = [], lm.in_one_task
    monkeypatch.setattr(lm, "in_one_task", lambda *a: begun.append(in_one_task(*a)) or {k: v.copy() for k, v in begun[-1].items()})
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.xxhash64("doc_id").alias("k1"), F.col("text").cast("binary").alias("text"))
    model, _ = lm.fit(docs, BYTE_BPE, sample_docs=20, windows=400)
    rows = [lm.coded(model, ids) for ids in lm.ids_of(lm.subwords(BYTE_BPE), [lm.words_of(bytes(r.text)) for r in docs.limit(50).collect()])]
    before, after = (np.concatenate([x[0] for x in attention.Scorer(p, model.codes, model.opens[model.frequent]).logs(rows)]).mean()
                     for p in (begun[-1], model.parameters))
    assert after > before + 0.02


@pytest.fixture(scope="module")
def small_model():
    codes = attention.Codes(6, (3, 4, 2), (False, True, True))
    draw = np.random.default_rng(0)
    windows = draw.integers(0, codes.size, (40, attention.LENGTH + 1))
    return codes, attention.fresh(codes, np.bincount(windows.ravel(), minlength=codes.size).astype(float)), windows


def test_gradients_by_differences(small_model):
    codes, p, windows = small_model
    p = {k: v.astype(np.float64) for k, v in p.items()}
    ids, targets, use = windows[:3, :-1], windows[:3, 1:], np.ones((3, attention.LENGTH), bool)
    use[1, 20:] = False

    def loss():
        scorer = attention.Scorer(p, codes, np.array([True, False] * 3))
        total = 0.0
        for logs, used in zip(scorer.logs(list(windows[:3])), use):
            total -= logs[0][used].sum()
        return total / use.sum()

    gradients = attention.gradients(p, codes, ids, targets, use)
    draw = np.random.default_rng(1)
    for name, values in p.items():
        spot = tuple(draw.integers(0, n) for n in values.shape)
        kept = values[spot]
        values[spot] = kept + 1e-5
        above = loss()
        values[spot] = kept - 1e-5
        below = loss()
        values[spot] = kept
        assert gradients[name][spot] == pytest.approx((above - below) / 2e-5, abs=1e-6), name


def test_windows_score_each_code_once():
    for size in range(2, 200):
        starts, firsts = attention.windows_of(size)
        places = [k for s, f in zip(starts, firsts) for k in range(f, min(s + attention.LENGTH, size - 1))]
        assert places == list(range(size - 1)) and (firsts - starts <= attention.LENGTH - attention.STRIDE).all()


def test_attention_is_causal_and_adds_up(small_model):
    codes, p, windows = small_model
    scorer = attention.Scorer(p, codes, np.array([True, False] * 3))
    row = windows[0]
    logs = scorer.logs([row])[0][0]
    changed = row.copy()
    changed[20:] = 0
    assert np.allclose(scorer.logs([changed])[0][0][:19], logs[:19])
    many = [row[:2], row, row[:9], np.concatenate([row] * 5), changed]
    assert all(np.allclose(a, scorer.logs([r])[0], atol=1e-4) for a, r in zip(scorer.logs(many, together=3), many))
    for place in (0, 5, 30):
        total = 0.0
        for code in range(codes.size):
            trial = row[:place + 2].copy()
            trial[place + 1] = code
            total += np.exp(scorer.logs([trial])[0][0][place])
        assert total == pytest.approx(1, abs=1e-4)


def test_scoring_works_out_each_place_once(small_model, monkeypatch):
    """Places that a window only looks at have no last layer, so it grows by the places scored, not by the windows."""
    codes, p, windows = small_model
    worked, last = [], attention.Scorer.last
    monkeypatch.setattr(attention.Scorer, "last", lambda *a: worked.append(last(*a)) or worked[-1])
    row = windows[:20].ravel()
    attention.Scorer(p, codes, np.array([True, False] * 3)).logs([row])
    assert len(row) - 1 <= sum(len(attention.flat(x)) for x in worked) <= len(row) - 1 + attention.STRIDE


def test_codes_by_tail(small_model):
    codes, _, windows = small_model
    some = windows.ravel()
    head = codes.heads[some]
    assert head.tolist() == [c if c <= 6 else 7 if c < 10 else 8 if c < 14 else 9 for c in some.tolist()]
    assert [x.tolist() for x in codes.by_tail(head)] == [np.flatnonzero(head == tail).tolist() for tail in (7, 8, 9)]
    assert [len(x) for x in codes.by_tail(head[:0])] == [0, 0, 0]


def test_adam_by_its_formula(small_model):
    codes, p, windows = small_model
    lengths = np.full(len(windows), attention.LENGTH + 1)
    plain = {k: v.copy() for k, v in p.items()}
    own = {k: v.copy() for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    adam = attention.Adam(own, codes)
    for n in (1, 2, 3):
        use = np.ones((len(windows), attention.LENGTH), bool)
        g = attention.gradients(plain, codes, windows[:, :-1], windows[:, 1:], use)
        for k in plain:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            plain[k] = plain[k] - 1e-3 * (first[k] / (1 - 0.9 ** n)) / (np.sqrt(second[k] / (1 - 0.99 ** n)) + 1e-8)
        adam.step(windows, lengths, 1e-3)
    assert own is adam.p and all(np.allclose(own[k], plain[k], atol=1e-5) for k in plain)


def test_texts_are_encoded_in_groups_of_bytes(spark, monkeypatch):
    """Ids don't depend on what is encoded in one go, and known cuts are looked up in rising order."""
    monkeypatch.setattr(lm, "ENCODED_BYTES", 60)
    texts = [None, "", "the cat", "zebra " * 40, "It's 12 o'clock", "\u4e2d\u6587 caf\u00e9", "a", None, "the cat sat on the mat " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    encoder = lm.subwords(BYTE_BPE)
    words = [tokens_of(text)[:-1] for text in texts]
    want = {k: encoder.ids(" " + " ".join(some)) if some else b"" for k, some in enumerate(words)}
    assert {r["doc_id"]: bytes(r["ids"]) for r in lm.encoded(docs.coalesce(1), BYTE_BPE).collect()} == want
    looked, places = [], type(encoder).places
    monkeypatch.setattr(type(encoder), "places", lambda self, hashes: looked.append(hashes) or places(self, hashes))
    encoder.encode_group([b"the cat sat on a mat by the door", b"new words 17"])
    assert looked and all((hashes[1:] > hashes[:-1]).all() for hashes in looked)


def test_lm_scores_do_not_depend_on_partitions(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 4_000)  # many shards, and models added in two steps
    monkeypatch.setattr(lm, "ADDED", 4)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.union(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 100_000))
    few, many = ({r["doc_id"]: r["score"] for r in rows_of(lm.lm_scores(docs.repartition(n), BYTE_BPE, F.col("doc_id") % 7 != 2, windows=400))} for n in (2, 9))
    # Products of single precision round differently in batches of other sizes.
    assert few == {k: pytest.approx(v, rel=1e-7) for k, v in many.items()}


def test_lm_scores_by_brute_force(spark):
    """The score of each text, worked out word by word from a plain forward pass over the model's windows."""
    words = ["the cat sat", "the dog sat on the mat", "zebra zebra", "", "a cat ran on"] * 8
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    made = []
    fit = lm.fit
    try:
        lm.fit = lambda *a, **k: made.append(fit(*a, **k)) or made[-1]
        rows = rows_of(lm.lm_scores(docs, BYTE_BPE, F.lit(True), top=3, windows=50))
    finally:
        lm.fit = fit
    model, p = made[0][0], {k: v.astype(np.float64) for k, v in made[0][0].parameters.items()}
    counts = collections.Counter(t for text in words for t in tokens_of(text))
    encoder, codes = lm.subwords(BYTE_BPE), model.codes

    def distribution(before):
        """Of the next code, after at most one window of codes."""
        x = p["embed"][before] + p["place"][:len(before)]
        q, k, v = np.split(x @ p["qkv"], 3, axis=1)
        weights = np.exp(q[-1] @ k.T / math.sqrt(attention.WIDTH))
        y = x[-1] + (weights / weights.sum()) @ v @ p["mix"]
        y = y + np.maximum(y @ p["up"] + p["up_bias"], 0) @ p["down"]
        soft = {name: np.exp(y @ p[name] + p[f"{name}_bias"]) for name in attention.softmaxes(codes)}
        soft = {name: some / some.sum() for name, some in soft.items()}
        tails = [soft["head"][codes.frequent + 1 + k] * soft[f"tail{k}"] for k in range(len(codes.tails))]
        return np.concatenate([soft["head"][:codes.frequent + 1], *tails])

    opening = np.zeros(codes.size, bool)
    opening[model.code[model.opens]] = True
    opening[codes.end] = True
    total, end = sum(counts.values()), codes.end
    kept = sum(n - 1 for n in counts.values())
    for row in rows:
        text = words[row["doc_id"]].split()
        ids = [np.frombuffer(encoder.ids(" " + w), encoder.dtype) for w in text]
        before, score = [end], 0.0
        for word, own in zip([*text, None], [*ids, None]):
            first = distribution(before)
            share = 1 - (1 - lm.ATTENTION) * kept / total
            chance = share / first[opening].sum()
            for k in (own if own is not None else []):
                chance *= distribution(before)[model.code[k]] * math.exp(model.beyond[k])
                before.append(model.code[k])
            chance *= first[end] if own is None else distribution(before)[opening].sum()
            score += math.log10(chance + (1 - lm.ATTENTION) * max(counts[word] - 1, 0) / total)
        assert row["score"] == pytest.approx(score, abs=1e-3)
