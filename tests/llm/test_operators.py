"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsetide.llm import byte_bpe, language_id, packing, shingles, suffix_dedup
from pulsetide.llm.components import components
from pulsetide.llm.exact_dedup import exact_dedup
from pulsetide.llm.line_dedup import class_keys, class_of, dedup_lines, line_decisions, within
from pulsetide.llm.ngram_jaccard import FANOUT, Tree, _unit_pairs, folded, jaccard_components, linked, point, tree_pairs
from pulsetide.llm.suffix_dedup import repeated_spans
from pulsetide.llm.topk_search import best_of_block, most_of_block, top_k
from pulsetide.llm.url_filters import filter_urls
from pulsetide.llm.warc_revisits import CAPTURE, canonical_url, resolve_revisits

DOC = "doc_id long, text string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_exact_dedup(spark):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "same"), (4, LONG), (5, LONG), (6, LONG[:-1] + "!"), (7, "é" * 40), (8, "é" * 40 + "e")]
    frame = docs(spark, rows).selectExpr("*", "'x' AS kept", "'y' AS keep_id")
    got = exact_dedup(frame).collect()
    assert len(got) == len(rows) and frame.columns[:2] == ["doc_id", "text"]
    by = lambda text: sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if (r.text or "") == text], key=repr)
    assert by("") == [(1, 2, 2, False), (2, 2, 2, True)]
    assert by("same") == [(3, 3, 3, False), (3, 3, 3, True), (None, 3, 3, False)]
    assert by(LONG) == [(4, 5, 2, False), (5, 5, 2, True)]
    assert all(r.kept and r.group_size == 1 for r in got if r.doc_id in (6, 7, 8))
    assert exact_dedup(docs(spark, [])).count() == 0


def test_url_filters(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, "nonsense"), (3, "http://a.Example.org/es/x?q"), (4, "http://example.org/en/12"), (5, "http://x.com/fr/"),
         (6, "http://org-x/"), (7, "http://org"), (8, "http://b.org/"), (8, "http://b.org/"), (9, "http://example.orgs/es/")],
        "page_id long, url string",
    ).selectExpr("*", "'clash' AS verdict")
    rules = spark.createDataFrame(
        [("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "example.org", "/en/1"), ("block", "example.org", "/en/1"),
         ("block", "com", None), (None, "org", "/"), ("block", None, "/")],
        "verdict string, host string, path string",
    )
    got = sorted((r.page_id, r.host, r.rule, r.verdict) for r in filter_urls(pages, rules, default="none").collect())
    assert got == sorted([
        (1, "", None, "none"), (2, "", None, "none"), (3, "a.example.org", "example.org/es/", "block"),
        (4, "example.org", "example.org/en/1", "block"), (5, "x.com", "com", "block"), (6, "org-x", None, "none"),
        (7, "org", None, "none"), (8, "b.org", "org/", "allow"), (8, "b.org", "org/", "allow"), (9, "example.orgs", None, "none"),
    ], key=lambda r: (r[0],))
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert filter_urls(pages, rules.limit(0)).filter("verdict = 'allow'").count() == 10


def test_top_k(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[50][1]) for i in range(30)]  # ties
    bad = [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (None, rows[0][1]), (303, []), (304, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank")
    got = top_k(frame, frame.filter("vec_id % 50 = 0"), 5).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert top_k(frame.limit(0), frame.limit(0), 5).count() == 0
    assert top_k(frame.filter("vec_id IN (303)"), frame.filter("vec_id = 303"), 5).count() == 0
    few = frame.filter("vec_id < 3")
    assert top_k(few, few.filter("vec_id = 0"), 5).count() == 2


def test_top_k_of_components_of_any_size(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(4)]) for i in range(130)]
    rows[50] = (50, [600_000.0, -1.5, 0.25, 3.0])
    rows[70], rows[71] = (70, [-7e6, 0.0, 1e9, 2.0]), (71, [524_288.0, 0.0, 0.0, 0.0])
    rows += [(200, [1e30, 0.0, 0.0, 0.0]), (201, [])]
    whole = {i: [int(np.floor(256 * np.float64(x))) for x in v] for i, v in rows}
    got = top_k(spark.createDataFrame([r for r in rows if r[0] < 200], "vec_id long, embedding array<double>"), spark.createDataFrame(rows[:101:50], "vec_id long, embedding array<double>"), 5)
    want = []
    for q in (0, 50, 100):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in range(130) if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(r[0] == 50 for r in want)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        top_k(frame, frame.filter("vec_id = 200"), 5).collect()


def test_pivots_spare_evaluations():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 300, (12, 16))
    rows = np.floor(centres[rng.integers(12, size=3000)] + rng.normal(0, 20, (3000, 16))).astype(np.int64)
    points = np.vstack([np.zeros((1, 16)), rows[:20]])
    distances = np.stack([np.linalg.norm(rows - p, axis=1) for p in points])
    ids, counts = np.arange(3000), []
    for own in range(0, 3000, 300):
        scores, found, with_pivots = best_of_block(rows[own], own, distances[:, own], ids, rows, distances, 5, -(1 << 62))
        _, same, by_length = best_of_block(rows[own], own, distances[:1, own], ids, rows, distances[:1], 5, -(1 << 62))
        brute = sorted((-int(rows[own] @ rows[i]), i) for i in range(3000) if i != own)[:5]
        assert [(-s, i) for s, i in zip(scores, found)] == brute and list(same) == list(found)
        counts.append((with_pivots, by_length))
        # A score to reach from another block spares the whole block.
        assert most_of_block(distances[:, own : own + 1], distances)[0] >= scores[0]
        assert best_of_block(rows[own], own, distances[:, own], ids, rows, distances, 5, 1 << 62)[2] == 0
    ours, lengths = map(sum, zip(*counts))
    assert ours < lengths / 2 and ours < 3000 * len(counts) / 4


def test_jaccard_edges(spark):
    base = [f"t{i}" for i in range(60)]
    near = [*base[:50], "other", *base[51:]]
    rows = [(5, " ".join(base)), (3, "  ".join(near).upper()), (9, None), (8, ""), (7, " \n "), (1, "a b"), (2, "A\tb"), (4, LONG), (6, LONG), (6, LONG), (None, " ".join(base))]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(docs(spark, rows).selectExpr("*", "1 AS component_id")).collect()}
    assert got[(5, 56)] == 3 and got[(3, 56)] == 3 and got[(None, 56)] == 3
    assert got[(9, 0)] == 9 and got[(8, 0)] == 8 and got[(7, 0)] == 7
    assert got[(1, 1)] == 1 and got[(2, 1)] == 1 and {k[0]: v for k, v in got.items() if k[0] in (4, 6)} == {4: 4, 6: 4}
    assert jaccard_components(docs(spark, [])).count() == 0


def test_tree_keeps_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 90, False), rng.integers(0, 2**63, n, dtype=np.uint64)])) for n in rng.integers(0, 40, 120)]
    width = max(len(point(s)) for s in sets)
    points = np.stack([np.bincount((s >> np.uint64(52)).astype(int) * width >> 12, minlength=width) for s in sets])
    tree = Tree(points, np.array([len(s) for s in sets]))
    found = {tuple(p) for p in tree_pairs(tree, tree, 75)}
    links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if linked(a, b, 75)}
    assert links <= found and len(links) > 120


def test_points_of_large_sets_lose_no_link():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**64, 2_000_000, dtype=np.uint64))
    crowded = base[(base >> np.uint64(51)) != 5]
    crowded = np.unique(np.concatenate([crowded, (np.uint64(5) << np.uint64(51)) + np.arange(600, dtype=np.uint64) * np.uint64(1 << 41)]))
    sets = [base, np.unique(np.concatenate([base[np.arange(len(base)) % 20 > 0], rng.integers(0, 2**64, 90_000, dtype=np.uint64)])), crowded]
    points = [point(one) for one in sets]
    assert all(p.dtype == np.uint8 and p.sum(dtype=np.int64) == len(one) for p, one in zip(points, sets))
    assert len(points[2]) > 2 * len(points[0])
    groups = min(map(len, points))
    least = [folded(p[None, :], groups)[0] for p in points]
    for a, b in ((0, 1), (0, 2), (1, 2)):
        assert linked(sets[a], sets[b], 75)
        assert np.minimum(least[a], least[b]).sum(dtype=np.int64) >= len(np.intersect1d(sets[a], sets[b], assume_unique=True))
    # Units of one leaf and of a tree, which small sets fill up.
    small = [rng.integers(0, 2**64, 70, dtype=np.uint64) for _ in range(FANOUT)]
    for all_sets in (sets, sets + small):
        n = len(all_sets)
        unit = {c: np.zeros(n, np.int64) for c in ("leader", "kind", "i", "j", "side")} | {
            "node": np.arange(n), "label": np.arange(n), "size": np.array([len(x) for x in all_sets])}
        batch = pa.RecordBatch.from_pydict(unit | {"point": [point(x).tobytes() for x in all_sets]})
        found = {(r["a"], r["b"]) for part in _unit_pairs(75)(iter([batch])) for r in part.to_pylist()}
        assert {(0, 1), (0, 2), (1, 2)} <= found


def test_shingles_ignore_blocks_and_case():
    texts = [b"One two  three four five six", b"", b"  ", b"one TWO three\tfour five six", b"x" * 3000 + b" y"]
    offsets = np.cumsum([0, *map(len, texts)])
    sets = list(shingles.shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets))
    assert [len(s) for s in sets] == [2, 0, 0, 2, 1] and (sets[0] == sets[3]).all()
    assert shingles.digest(sets[1]) == 0 and shingles.digest(sets[0]) == shingles.digest(sets[3]) != 0


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (12, 11), (5, 5), (2, 1), *[(100, i) for i in range(101, 160)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, **{i: 100 for i in range(100, 160)}}


def test_suffix_array_and_prefixes():
    text = np.frombuffer(bytes(random.Random(3).choice(b"ab") for _ in range(1500)), np.uint8)
    raw = text.tobytes()
    order = suffix_dedup.suffix_array(text, 2048)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])

    def prefix(i, j):
        n = 0
        while n < 256 and max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
            n += 1
        return n

    assert suffix_dedup.common_prefixes(text, order, 256).tolist() == [0, *[prefix(a, b) for a, b in zip(order, order[1:])]]


def test_repeated_spans_edges(spark):
    passage = "é" * 3 + "".join(random.Random(1).choice("abcdefgh ") for _ in range(300))
    rows = [(1, "x" + passage + "y"), (2, "q" + passage + "zz"), (3, None), (4, ""), (5, "short"), (5, "short"), (6, "k" * 900), (7, "m" * 200), (8, "m" * 200)]
    got = {r.doc_id: r for r in repeated_spans(docs(spark, rows).selectExpr("*", "1 AS n_bytes", "2 AS left")).collect()}
    assert bytes(got[1].left) == b"xy" and bytes(got[2].left) == b"qzz"
    assert got[1].span_starts == [1] and got[1].span_ends == [1 + len(passage.encode())]
    assert all(bytes(got[k].left) == b"" for k in (3, 4, 6, 7, 8)) and bytes(got[5].left) == b"short"
    assert repeated_spans(docs(spark, [])).count() == 0


def test_bpe_offsets_and_split_characters(spark):
    described = byte_bpe.load()
    text = "naïve 🙂🙂 日本語  x"
    frame = docs(spark, [(1, text), (2, None), (3, ""), (4, LONG)]).selectExpr("*", "1 AS ids")
    rows = {r.doc_id: r for r in byte_bpe.encode(frame, described, offsets=True).collect()}
    assert rows[2].ids == [] and rows[3].ids == [] and len(rows[4].ids) > 30_000
    table = byte_bpe.ByteTable(described)
    for token, start, end in zip(rows[1].ids, rows[1].char_starts, rows[1].char_ends):
        assert table.decode(np.array([token])).tobytes() in text[start:end].encode()
    back = byte_bpe.decode(byte_bpe.encode(frame, described), described).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {1: text, 2: "", 3: "", 4: LONG}
    cut = [i for i in rows[1].ids if len(table.decode(np.array([i]))) < 3][:1] + rows[1].ids[3:4]
    assert isinstance(byte_bpe.text_of(table.decode(np.array(cut)).tobytes()), str)
    assert byte_bpe.encode(docs(spark, []), described).count() == 0


def test_bpe_of_many_texts_in_blocks(spark, monkeypatch):
    described = byte_bpe.load()
    table = byte_bpe.ByteTable(described)
    texts = ["né", "", "🙂", "日本", "", "x" * 9, "ö"]
    ids = [np.array(x, np.int64) for x in _library_ids(described, texts)]
    bounds = np.append(0, np.cumsum([len(x) for x in ids]))
    starts, ends = table.character_spans(np.concatenate(ids), bounds)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert (ends[a:b].max(initial=0), starts[a:b].min(initial=0)) == (len(text), 0)
    rows = [(1, ids[0].tolist()), (1, ids[0].tolist()), (2, None), (3, []), (4, ids[3].tolist())]
    monkeypatch.setattr(byte_bpe, "BLOCK_IDS", 2)
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>").selectExpr("*", "'z' AS decoded")
    got = sorted((r.doc_id, bytes(r.decoded).decode()) for r in byte_bpe.decode(frame, described).collect())
    assert got == [(1, "né"), (1, "né"), (2, ""), (3, ""), (4, "日本")]
    none = byte_bpe.encode(docs(spark, [(2, None)]).selectExpr("*", "0 AS ids_sha256"), described, digest=True).first()
    assert none.ids_sha256 == hashlib.sha256(b"").hexdigest()


def _library_ids(described, texts):
    tokenizer = Tokenizer.from_str(described)
    return [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_language_edges(spark):
    network = language_id.Network.fresh(["a", "b"], 4)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, LONG), (5, "é")]
    got = {r.doc_id: r for r in language_id.identify(docs(spark, rows).selectExpr("*", "'c' AS score"), network).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and {got[4].lang_pred, got[5].lang_pred} <= {"a", "b"}
    assert language_id.learn(spark.createDataFrame([(1, "x", None)], DOC + ", lang string")) is None
    assert [r.lang_pred for r in language_id.identify(docs(spark, rows), None).collect()] == ["und"] * 5


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    network = language_id.Network.fresh(["a", "b", "c"], 3)
    codes, labels = rng.integers(97, 110, (7, 4)).astype(np.int16), np.array([0, 1, 2, 0])
    codes[5:, 1] = language_id.PAD

    def loss():
        found, _ = network.positions(codes)
        there = codes != language_id.PAD
        return -(np.log(found[:, labels, np.arange(4)]) * there).sum() / there.sum()

    for parameter, gradient in zip(network.parameters(), network.gradients(codes, labels)):
        for _ in range(6):
            at = tuple(rng.integers(n) for n in parameter.shape)
            if parameter.shape[1] == 257:
                at = (at[0], int(rng.integers(97, 110)))
            old = parameter[at]
            parameter[at] = old + 1e-2
            up = loss()
            parameter[at] = old - 1e-2
            down = loss()
            parameter[at] = old
            assert gradient[at] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_packing_edges(spark):
    described = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)).to_str()
    rows = [(1, None), (1, None), (None, "a b"), (2, LONG), (3, "same words"), (4, "same words")]
    got = packing.pack(docs(spark, rows).selectExpr("*", "1 AS offset"), described).collect()
    assert sum(r.length for r in got) == sum({(r.doc_id, r.start): r.doc_tokens for r in got if not r.start}.values()) + 1
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack(docs(spark, []), described).count() == 0


def test_patterns_hold_every_length():
    rnd = random.Random(2)
    histogram = {rnd.randint(1, 100): rnd.randint(1, 5000) for _ in range(60)}
    patterns = packing.pack_histogram(histogram, 100)
    assert all(sum(p) <= 100 for p, _ in patterns)
    assert all(sum(c * p.count(n) for p, c in patterns) == k for n, k in histogram.items())
    places = packing.Places(patterns)
    seen = [places.of(n, i) for n, k in histogram.items() for i in range(k)]
    assert len(set(seen)) == len(seen)


def distance(a, b, most=2):
    """Edit distance, or one more than ``most`` where it is larger."""
    row = {j: j for j in range(most + 1)}
    for i in range(1, len(a) + 1):
        old, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            ways = [old.get(j, most) + 1, row.get(j - 1, most) + 1]
            if j and j - 1 in old:
                ways.append(old[j - 1] + (a[i - 1] != b[j - 1]))
            row[j] = min(ways) if i and (j or i) else 0
        if not row:
            return most + 1
    return min(row.get(len(b), most + 1), most + 1)


def test_network_equals_plain_python(monkeypatch):
    monkeypatch.setattr(language_id, "SEGMENT", 8)
    monkeypatch.setattr(language_id, "LANES", 3)
    network = language_id.Network.fresh(["a", "b", "c"], 3, seed=4)

    def states(side, codes):
        h, out = [0.0] * 3, []
        for code in codes:
            added = [float(side.inputs[r][code]) for r in range(9)]
            own = [sum(float(side.state[r][j]) * h[j] for j in range(3)) for r in range(9)]
            update, reset = ([1 / (1 + math.exp(-2 * (added[g + i] + own[g + i]))) for i in range(3)] for g in (0, 3))
            new = [math.tanh(added[6 + i] + reset[i] * own[6 + i]) for i in range(3)]
            h = [update[i] * h[i] + (1 - update[i]) * new[i] for i in range(3)]
            out.append(h)
        return out

    texts = ["", "x", "ABC abc!", "nine byte", "é" * 13 + "Zz", "one two three four five six seven"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    found = network.documents(raw, offsets)
    for text, got in zip(texts, found):
        codes = [c + 32 if 65 <= c <= 90 else c for c in text.encode()]
        sums = [0.0] * 3
        for at in range(0, len(codes), 8):
            part = codes[at : at + 8]
            ahead, behind = states(network.forward, part), states(network.backward, part[::-1])[::-1]
            for seen, coming in zip(ahead, behind):
                values = [sum(float(w) * v for w, v in zip(line, [*seen, *coming, 1.0])) for line in network.out]
                total = sum(map(math.exp, values))
                sums = [s + math.exp(v) / total for s, v in zip(sums, values)]
        want = [s / max(len(codes), 1) for s in sums]
        assert np.allclose(got, want, atol=1e-5), text


def test_every_language_is_learned(spark):
    assert language_id.sizes(4) == (8, 250) and language_id.sizes(8) == (8, 250) and language_id.sizes(300)[1] == 38 * 250
    rows = [(i, chr(97 + i % 20) * 60, f"l{i % 20:02}") for i in range(60)] + [(100, "rare ŵŵŵŵ ŵŵŵŵ", "rare"), (101, None, "none"), (102, "a", None)]
    labelled = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string, lang string")
    network = language_id.learn(labelled, steps=2)
    assert network.languages == sorted({f"l{i:02}" for i in range(20)} | {"rare"}) and network.forward.state.shape[1] == 16
    got = language_id.identify(labelled, network).collect()
    assert len(got) == 68 and len({(r.lang_pred, r.score) for r in got if r.doc_id == 1}) == 1
    assert language_id.learn(labelled.limit(0)) is None and language_id.identify(labelled.limit(0), network).count() == 0


def test_a_long_line_and_its_near_copy(spark):
    rnd = random.Random(12)
    long = "".join(rnd.choice("abcdefg ") for _ in range(12_000))
    rows = [(1, long), (2, long[:6_000] + "Z" + long[6_001:]), (3, long[:-1]), (4, long[3:]), (5, long[::-1])]
    frame = docs(spark, rows).selectExpr("*", "'x' AS dropped_lines", "1 AS line_no", "2 AS n_lines")
    assert {r.doc_id: r.dropped_lines for r in line_decisions(frame).collect()} == {1: [], 2: [0], 3: [0], 4: [], 5: []}
    kept = {r.doc_id: (r.text, r.dropped_lines) for r in dedup_lines(frame).collect()}
    assert kept[2] == ("", "x") and kept[1] == (long, "x")


def test_lines_against_brute_force(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(15, 40))) for _ in range(12)]

    def changed(line):
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(line))
            line = rnd.choice([line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "q" + line[at + 1 :]])
        return line

    rows = [(k, "\n".join(changed(rnd.choice(base)) if rnd.random() < 0.9 else rnd.choice(["", "  ", "tiny"]) for _ in range(6))) for k in range(15)]
    rows += [(100, None), (101, ""), (None, base[0]), (102, LONG), (103, LONG + "!")]
    got = {r.doc_id: (r.n_lines, r.dropped_lines) for r in line_decisions(docs(spark, rows)).collect()}
    place = [(k is not None, k or 0, n, line) for k, text in rows for n, line in enumerate((text or "").split("\n"))]
    firsts = {}
    for known, k, n, line in sorted(place):
        firsts.setdefault(line, (known, k, n))
    close = {
        x for x, at in firsts.items() if 20 <= len(x) and x.strip()
        and any(20 <= len(y) and y.strip() and firsts[y] < at and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2 for y in firsts if y != x)
    }
    for k, text in rows:
        lines = (text or "").split("\n")
        want = [n for n, line in enumerate(lines) if line.strip() and (firsts[line] != (k is not None, k or 0, n) or line in close)]
        assert got[k] == (0 if text is None else len(lines), want), k
    assert dedup_lines(docs(spark, [(1, "same line here"), (2, "same line here\nmore")])).orderBy("doc_id").collect()[1].text == "more"
    assert line_decisions(docs(spark, [])).count() == 0


def test_revisits(spark):
    rows = [
        ("r1", "http://www.A.com/x/?utm_a=1#f", 100, 200, 'W/"1"', None, {"Content-Type": "t", "Date": "1"}, "d1"),
        ("r2", "https://a.com:443/x", 200, 304, '"1"', None, {"date": "2", "content-type": "no"}, None),
        ("r3", "http://a.com/x", 300, 304, '"2"', None, None, None),
        ("r4", "http://a.com/x", 50, 304, '"1"', None, None, None),
        ("r5", "http://a.com/x", 100_000, 304, None, None, None, None),
        ("r6", None, 1, 304, None, None, None, None),
        ("r7", "http://a.com/x", 150, 404, None, None, None, None),
        ("r8", "http://a.com/x", None, 304, None, None, None, None),
        ("r9", "http://a.com/x", 120, None, None, None, None, None),
        ("r5", "http://a.com/x", 100_000, 304, None, None, None, None),
    ]
    got = resolve_revisits(spark.createDataFrame(rows, CAPTURE).selectExpr("*", "1 AS outcome")).collect()
    assert len(got) == 10
    by = {r.record_id: r for r in got}
    assert [by[k].outcome for k in ("r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "r9")] == [
        "full", "resolved", "changed", "missing", "unchecked", "missing", "other", "missing", "other"]
    assert by["r2"].resolved_id == "r1" and by["r2"].payload_digest == "d1"
    assert by["r2"].headers == {"Content-Type": "t", "date": "2"}
    assert resolve_revisits(spark.createDataFrame([], CAPTURE)).count() == 0
    (key,) = spark.range(1).select(canonical_url(__import__("pyspark").sql.functions.lit("ftp://WWW.b.org:80/?b=2&utm_x=1"))).first()
    assert key == "b.org?b=2"


def test_lines_within_the_threshold_share_a_class_key(spark):
    rnd, pairs = random.Random(8), []
    for length in [*range(20, 70), *range(118, 134), 250, 256, 257, 511, 513]:
        for _ in range(6):
            left = right = "".join(rnd.choice("abcd") for _ in range(length))
            for _ in range(2):
                at = rnd.randrange(len(right))
                right = rnd.choice([right[:at] + right[at + 1 :], right[:at] + "z" + right[at:], right[:at] + "q" + right[at + 1 :]])
            pairs.append((left, right))

    def keys(column):
        line = F.col(column)
        length = F.char_length(line)
        return F.concat(*[class_keys(line, class_of(length + more, 2), 2) for more in (0, 2)])

    table = spark.createDataFrame(pairs, "x string, y string")
    assert table.filter(~F.arrays_overlap(keys("x"), keys("y"))).count() == 0


def test_edits_of_long_lines(spark):
    rnd, pairs = random.Random(9), []
    for length in [0, 1, 2, 3, 4, 7, 8, 9, 20, 33]:
        for _ in range(30):
            left = right = "".join(rnd.choice("abé") for _ in range(length))
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randrange(len(right) + 1)
                right = rnd.choice([right[:at] + right[at + 1 :], right[:at] + "b" + right[at:], right[:at] + "a" + right[at + 1 :]])
            pairs.append((left, right))
    frame = spark.createDataFrame(pairs, "x string, y string")
    for threshold in (0, 1, 2, 3):
        got = frame.select("x", "y", within(F.col("x"), F.col("y"), threshold).alias("near")).collect()
        assert [r.near for r in got] == [distance(r.x, r.y, 4) <= threshold for r in got]
    line = "é" + LONG
    rows = [(1, line), (2, line[1:-1]), (3, "q" + line + "q" + "q"), (4, line[:5] + line[6:90_000] + "é" + line[90_000:]), (5, LONG[::-1]), (6, "short " * 4 + "\n" + line)]
    dropped = {r.doc_id: r.dropped_lines for r in line_decisions(docs(spark, rows), most=None).collect()}
    assert dropped == {1: [], 2: [0], 3: [], 4: [0], 5: [], 6: [1]}
    assert {r.doc_id: r.text for r in dedup_lines(docs(spark, rows[:2])).collect()} == {1: line, 2: ""}


def test_verifying_deals_only_texts_of_pairs_and_packs_points(spark, tmp_path):
    import pyarrow.compute as pc

    from pulsetide.llm import ngram_jaccard as j

    one = point(np.arange(1000, dtype=np.uint64) << np.uint64(54))
    batch = pa.RecordBatch.from_pydict({"node": [1], "point": [j.packed(one)]})
    assert next(j.unpacked(iter([batch]))).column("point")[0].as_py() == one.tobytes()
    path = str(tmp_path / "texts")
    spark.range(3000).selectExpr("id AS node", "concat('a b c d e f ', id DIV 2) AS text").write.parquet(path)
    # From a map, so that their number is not known before.
    pairs = spark.range(2, 6, 2).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([b.column(0), pc.add(b.column(0), 1)], ["a", "b"]) for b in batches),
        "a long, b long",
    )
    found = j.verified(pairs, spark.read.parquet(path), 5, 75)
    assert sorted(tuple(r) for r in found.collect()) == [(2, 3), (4, 5)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Every scan of the texts meets the pairs' nodes as a broadcast before any exchange.
    assert plan.count("BroadcastHashJoin [node") >= 2


def test_points_of_a_large_batch_are_unpacked_and_compared_part_by_part():
    import tracemalloc

    from pulsetide.llm import ngram_jaccard as j
    from pulsetide.llm.common import BLOCK_BYTES

    rng = np.random.default_rng(5)
    count = 2400
    points = [j.point(rng.integers(0, 2**64, 4000, np.uint64)) for _ in range(count)]
    for node in range(1, count, 20):  # of its group's other node, without one shingle
        points[node] = points[node - 1].copy()
        points[node][np.argmax(points[node])] -= 1
    numbers = np.arange(count)
    columns = {
        "leader": numbers // 2, "kind": numbers * 0, "i": numbers * 0, "j": numbers * 0, "node": numbers, "label": numbers,
        "side": numbers * 0, "size": np.array([int(p.sum()) for p in points]), "point": [j.packed(p) for p in points],
    }
    batch = pa.RecordBatch.from_pydict(columns)
    parts = list(j.unpacked(iter([batch])))
    assert [x for part in parts for x in part.column("point").to_pylist()] == [p.tobytes() for p in points]
    assert [x for part in parts for x in part.column("node").to_pylist()] == list(range(count))
    assert max(part.column("point").nbytes for part in parts) < 2 * BLOCK_BYTES
    del parts
    tracemalloc.start()
    found = [(r["a"], r["b"]) for part in j._unit_pairs(75)(j.unpacked(iter([batch]))) for r in part.to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found) == [(node - 1, node) for node in range(1, count, 20)]
    assert most < 40 << 20  # 9 MB of points; all at once, with an index of every byte, took over 200 MB


def test_a_step_gives_back_what_it_freed():
    from pathlib import Path

    from pulsetide.llm.common import returning

    def own():
        return sum(int(line.split()[1]) for line in Path("/proc/self/smaps_rollup").read_text().splitlines() if line.startswith("Pss_Anon:")) >> 10

    pinned = []  # what lies between freed blocks keeps them from going back by themselves

    def step(batches):
        for batch in batches:
            freed = []
            for _ in range(2000):
                freed.append(np.ones(100_000, np.uint8))
                pinned.append(np.ones(2000, np.uint8))
            del freed
            yield batch

    assert list(returning(step)(iter([]))) == []
    before = own()
    assert list(step(iter([1]))) == [1]
    held = own() - before
    assert list(returning(step)(iter([1, 2]))) == [1, 2]
    assert held > 100 and own() - before < 50


def test_pairs_of_large_units_come_unit_by_unit():
    import tracemalloc

    units, nodes = 8, 300
    numbers = np.arange(units * nodes)
    one = point(np.arange(60, dtype=np.uint64) << np.uint64(58))
    batch = pa.RecordBatch.from_pydict({
        "leader": numbers // nodes, "kind": numbers * 0, "i": numbers * 0, "j": numbers * 0, "node": numbers, "label": numbers,
        "side": numbers * 0, "size": numbers * 0 + 60, "point": [one.tobytes()] * len(numbers),
    })
    tracemalloc.start()
    sizes = [len(part) for part in _unit_pairs(75)(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == units * nodes * (nodes - 1) // 2 and max(sizes) == nodes * (nodes - 1) // 2
    assert most < 24 << 20


def texts_with_phrases(rng):
    """Words of 1,500 texts: four phrases of many texts (each in about 15) among words of their own."""
    texts = []
    for nr in range(1500):
        words = []
        for part, phrase in enumerate(rng.integers(0, 400, 4)):
            words += [f"p{phrase}w{k}" for k in range(5)] + [f"own{nr}x{part}x{k}" for k in range(6)]
        texts.append(words)
    return texts


def test_shingles_of_many_texts_make_no_groups(spark, monkeypatch):
    from pulsetide.llm import ngram_jaccard as j

    rows = {}

    def counted(frame, name, write=j.written):
        out = write(frame, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(j, "written", counted)
    rng = np.random.default_rng(11)
    texts = texts_with_phrases(rng)
    copies = [words[:-1] + ["other"] for words in texts[:20]]
    table = [(nr, " ".join(words)) for nr, words in enumerate(texts + copies)]
    got = {r.doc_id: r.component_id for r in j.jaccard_components(docs(spark, table)).collect()}
    assert got == {nr: nr if nr < 1500 else nr - 1500 for nr in range(1520)}
    # 1,774 when only shingles of a large share of a batch were told from rare ones.
    assert 40 <= rows["groups-alive"] < 200


def test_counters_of_tasks_are_summed_and_order_alone_loses_no_link():
    from pulsetide.llm import ngram_jaccard as j

    text = lambda nr: " ".join(f"t{nr}w{k}" for k in range(5))
    tasks = [[text(0)] * 3, [text(0)], [f"{text(0)} {text(nr)}" for nr in range(300)], []]
    sent = [
        row
        for task in tasks
        for batch in j._describe(5)(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(task))), "text": pa.array(task, pa.string())})]))
        for row in batch.to_pylist()
        if row["kind"]
    ]
    sent.sort(key=lambda row: row["piece"])
    schema = pa.schema([("piece", pa.int32()), ("counts", pa.binary())])
    batches = [pa.RecordBatch.from_pylist([{c: row[c] for c in schema.names}], schema) for row in sent]
    classes = np.zeros((j.PIECES, (1 << j.COUNTER_BITS) // j.PIECES), np.uint8)
    for batch in j._classes(iter(batches)):
        for row in batch.to_pylist():
            classes[row["piece"]] = np.frombuffer(row["classes"], np.uint8)
    once = next(j._sets(pa.array([text(7)]), 5))
    often = next(j._sets(pa.array([text(0)]), 5))
    flat = classes.reshape(-1)
    # Equal texts of a batch count once, and a task counts to 255: 1 + 1 + 255 texts.
    assert flat[j.counters(often)].tolist() == [round(8 * np.log2(258))]
    assert flat[j.counters(once)].tolist() == [8]

    rng = np.random.default_rng(3)
    classes = rng.integers(0, 4, 1 << j.COUNTER_BITS).astype(np.uint8)
    for size in (1, 4, 30, 700):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64, size, np.uint64))
            away = rng.permutation(len(a))[: int(len(a) * rng.uniform(0, 0.2))]
            b = np.unique(np.concatenate([np.delete(a, away), rng.integers(0, 2**64, size // 20, np.uint64)]))
            if linked(a, b, 75):
                both = np.intersect1d(j.prefix(a, classes, 75), j.prefix(b, classes, 75))
                assert len(both) >= min(j.shared_needed(len(a)), j.shared_needed(len(b)))


def test_nodes_of_a_shingle_that_no_size_connects_share_no_group():
    from pulsetide.llm import ngram_jaccard as j

    # By shingle, the sizes of the nodes that hold it; nodes count up.
    sizes = {5: [100, 200], 6: [300, 75, 100, 310, 130], 9: [16]}
    table = [(value, size) for value, some in sizes.items() for size in some]
    batch = pa.RecordBatch.from_pydict({
        "bucket": [0], "shingles": [np.array([v for v, _ in table], np.uint64).tobytes()],
        "nodes": [np.arange(len(table)).tobytes()], "sizes": [np.array([n for _, n in table], np.uint32).tobytes()],
    })
    found = [tuple(row.values()) for part in j._groups(75)(iter([batch, batch])) for row in part.to_pylist()]
    assert found == [(2, 5, 1), (3, 4, 1), (3, 6, 1)]


def test_near_copies_in_the_pipeline_meet_no_texts_of_common_phrases(spark, monkeypatch):
    import corpus_pipeline
    from pulsetide.llm import ngram_jaccard as j

    rows = []

    def counted(frame, name, write=j.written):
        out = write(frame, name)
        rows.extend([out.count()] if name == "texts" else [])
        return out

    monkeypatch.setattr(j, "written", counted)
    texts = texts_with_phrases(np.random.default_rng(12))
    table = docs(spark, [(nr, " ".join(words)) for nr, words in enumerate(texts + [texts[7][1:], texts[8][:-1]])])
    table = table.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "char_length(text) AS n_chars")
    kept = corpus_pipeline.drop_near_copies(spark, table, "")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(1500))
    assert rows[0] < 100  # texts that are dealt and made points; 1,129 before
