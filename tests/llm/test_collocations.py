"""Collocations against plain Python."""

import random
import re
from collections import Counter

import pytest

from pulsetide.llm import collocations as c


def brute(rows, least, longest, reported=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    often = {p: n for p, n in counts.items() if n >= least}
    out = {}
    for (lang, words), a in often.items():
        if len(words) > 1:
            cuts = [(2_000_000 * a // (often[lang, words[:k]] + often[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out[lang, words] = (a, often[lang, words[:k]], often[lang, words[k:]], score)
    most = Counter()
    for (lang, words), (a, *_) in out.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                most[part] = max(most[part], a)
    kept = [(p, v) for p, v in out.items() if not (p in most and 100 * most[p] >= 80 * v[0])]
    result = []
    for lang in {p[0] for p, _ in kept}:
        own = sorted(((-v[3], -v[0], " ".join(p[1]).encode(), v) for p, v in kept if p[0] == lang))
        result += [(lang, rank, phrase.decode(), v[0], v[1], v[2], totals[lang], v[3]) for rank, (_, _, phrase, v) in enumerate(own[:reported], 1)]
    return sorted(result)


def sample(seed, count=400):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "on", "é", "MAT", "İx", "日本", "a", "b\xa0c", "x\x1fy", "nur"]
    glue = [" ", " ", " ", " ", "\t", "  ", ", ", "\n", " .", "!?", "\r\x0b"]
    rows = []
    for i in range(count):
        text = "".join(rng.choice(words[: rng.choice([3, 5, 12])]) + rng.choice(glue) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    return rows + [("en", None), (None, ""), ("fr", " ".join(["la"] * 5000)), ("de", "x" * 100_000), ("de", " . , ")] + [("en", "hot phrase here now")] * 300


def ours(spark, rows, parts=6, **options):
    frame = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")
    frame = frame.selectExpr("*", "1 AS shard", "'x' AS phrase", "2 AS f").repartition(parts)
    return sorted(tuple(r) for r in c.collocations(frame, **options).collect())


@pytest.mark.parametrize("shards, least, longest", [(1, 5, 4), (2, 30, 4), (3, 8, 5)])
def test_equals_plain_python(spark, shards, least, longest):
    rows = sample(shards)
    want = brute(rows, least, longest)
    assert ours(spark, rows, shards=shards, least=least, longest=longest) == want and len(want) > 20


def test_places_of_marks_do_not_change_results(spark, monkeypatch):
    rows = sample(7)
    monkeypatch.setattr(c, "PLACE_BITS", 3)
    monkeypatch.setattr(c, "BLOCK_BYTES", 500)
    assert ours(spark, rows, least=6) == brute(rows, 6, 4)


def test_only_the_best_are_reported(spark):
    rows = sample(9)
    assert ours(spark, rows, least=5, reported=7) == brute(rows, 5, 4, 7)


def test_a_cycle_counts_every_shard_once(spark):
    # Frequent in the last shard only: its phrases become active late and are still counted whole.
    rows = [("en", "rare one two three")] * 40
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    blocks = c.word_blocks(frame, 3).selectExpr("CAST(2 AS int) AS shard", "lang", "words", "vocabulary", "tokens")
    found = {(r.phrase, r.f) for r in c.frequent_phrases(blocks, shards=3).collect()}
    assert ("rare one two three", 40) in found and len(found) == 10


def test_empty_table(spark):
    assert ours(spark, []) == []
    assert ours(spark, [("en", None), (None, " , ")]) == []


@pytest.mark.parametrize("bits", [6, 8])
def test_a_place_marked_earlier_by_another_phrase_loses_no_count(spark, monkeypatch, bits):
    # Some parts become frequent in the second scan only, while the place of a phrase of theirs is
    # marked by another since the first; a phrase around it still needs a full cycle.
    rng = random.Random(1)
    rows = []
    for _ in range(1500):
        text = []
        for _ in range(8):
            if rng.random() < 0.5:
                text.append(f"w{min(59, int(rng.expovariate(0.1)))}")
            else:
                k = min(20, int(rng.expovariate(0.25)))
                text += [f"p{k}{end}" for end in "abcd"]
        rows.append(("en", " ".join(text)))
    monkeypatch.setattr(c, "PLACE_BITS", bits)
    assert ours(spark, rows) == brute(rows, 30, 4)
