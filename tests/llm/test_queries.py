"""Every registered query against its SQL twin or plain Python, over whole small tables."""

import hashlib
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from pulsetide.llm import byte_bpe, suffix_dedup
from pulsetide.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = connection.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    assert [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    rows = lambda t: sorted(map(repr, t.select(columns).to_pylist()))
    assert rows(got) == rows(want) and len(got) > 0


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()


def repeated(texts, width):
    """Bytes covered by a string of the width that starts elsewhere too."""
    found = defaultdict(int)
    for text in texts:
        for i in range(len(text) - width + 1):
            found[text[i : i + width]] += 1
    out = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - width + 1):
            if found[text[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        out.append(gone)
    return out


def test_suffix_dedup_equals_brute_force(spark):
    docs = documents(spark)
    texts = [row.text.encode() for row in docs]
    want = {}
    for row, text, gone in zip(docs, texts, repeated(texts, 200)):
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        left = bytes(b for b, x in zip(text, gone) if not x)
        want[row.doc_id] = (len(text), sum(gone), spans, hashlib.sha256(left).hexdigest())
    got = QUERIES["op3_suffix_array_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert sum(x[1] for x in want.values()) > 0


def test_bpe_equals_tiktoken_and_round_trips(spark):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_byte_bpe"](spark, SMALL).collect()}
    for row in documents(spark):
        ids = own.encode_ordinary(row.text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        assert got.pop(row.doc_id) == (len(ids), sha(packed), sha(row.text.encode()), len(row.text))
    assert not got


def test_languages_of_documents_not_learned_from(spark):
    lang = {row.doc_id: row.lang for row in documents(spark)}
    got = QUERIES["op5_language_id"](spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert len(held) > 20 and sum(held) / len(held) > 0.95


def packed_right(spark, rows, texts):
    """Pieces follow each other in documents and in sequences, with the library's own ids."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {key: tokenizer.encode(text or "", add_special_tokens=False).ids + [2] for key, text in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for key, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            piece = ids[key][r.start : r.start + r.length]
            packed = b"".join(i.to_bytes(4, "little") for i in piece)
            assert r.start == at and r.doc_tokens == len(ids[key]) and r.ids_crc32 == zlib.crc32(packed)
            at += r.length
        assert at == len(ids[key])
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing_is_whole_and_dense(spark):
    rows = QUERIES["op10_packing"](spark, SMALL).collect()
    sequences, tokens = packed_right(spark, rows, {r.doc_id: r.text for r in documents(spark)})
    assert sequences <= -(-tokens // 4096) + 1


def words(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text):
    found = words(text or "")
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    for name, stage in list(stages.items())[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        rows = out.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows)
        if name == "language ID":
            assert after == {k: text for k, text in kept.items() if any(c.isalpha() for c in text or "")}
        if name == "exact dedup":
            largest = {text: max(k for k, v in kept.items() if v == text) for text in kept.values()}
            assert after == {k: text for text, k in largest.items()}
        if name == "n-gram Jaccard join":
            sets = {k: shingles(v) for k, v in kept.items()}
            group = {k: k for k in kept}

            def root(x):
                while group[x] != x:
                    x = group[x]
                return x

            keys = sorted(kept)
            for i, a in enumerate(keys):
                for b in keys[i + 1 :]:
                    both = len(sets[a] & sets[b])
                    if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        group[y] = x
            assert set(after) == {k for k in keys if root(k) == k}
        if name == "suffix-array dedup":
            texts = [kept[k].encode() for k in sorted(kept)]
            left = {}
            for k, text, gone in zip(sorted(kept), texts, repeated(texts, 200)):
                rest = bytes(b for b, x in zip(text, gone) if not x).decode(errors="ignore")
                if rest.strip() or not any(gone):
                    left[k] = rest
            assert after == left and all(r.n_chars == len(r.text) for r in rows if r.text != kept[r.doc_id])
        spark.createDataFrame(rows, out.schema)
        docs, kept = spark.createDataFrame(rows, out.schema), after
    packed_right(spark, stages["packing"](spark, docs, SMALL).collect(), kept)


def test_every_document_with_a_letter_stays(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.filter("doc_id < 100").collect()
    parts = {r.lang: r.text.replace("\n", " ")[:300] for r in rows}
    mixed = ["".join(parts.values())[:k] for k in (None, 700)] + ["qzx " * 50, "7 7 7 a 7 7"]
    more = [(10_000 + k, text, None, "x", len(text)) for k, text in enumerate([*mixed, "7 7 7", ""])]
    frame = spark.createDataFrame([*map(tuple, rows), *more], docs.schema)
    out = {r.doc_id for r in corpus_pipeline.identify_languages(spark, frame, SMALL).select("doc_id").collect()}
    assert len(parts) > 2 and out == {r.doc_id for r in rows} | {10_000 + k for k in range(len(mixed))}


def run_stages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append({(r.doc_id, r.text) for r in docs.collect()})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    return out, last


def test_pipeline_of_odd_rows_and_of_none(spark):
    words_of = lambda seed, n: " ".join(hashlib.sha256(f"{seed}{i}".encode()).hexdigest()[:7] for i in range(n))
    passage = words_of("p", 40)
    rows = [
        (1, words_of(1, 60), "en", "a", 1), (1, words_of(1, 60), "en", "a", 1), (None, words_of(2, 60), None, None, None),
        (3, None, "en", "a", 0), (4, "", "de", "a", 0), (5, "123 ...", "de", "a", 7), (6, "x", "de", "a", 1), (6, "y", "de", "a", 1),
        (7, f"{words_of(7, 70)} \ufffd\ufffd {passage} é\ufffd", "fr", "a", 1), (8, f"é {passage} ü {words_of(8, 70)} \ufffd", "fr", "a", 1),
    ]
    out, last = run_stages(spark, rows)
    language, exact, near, repeats = out
    # No letter: rows 3 to 5. Equal rows fold to one, and so does no other.
    assert {k for k, _ in language} == {1, None, 6, 7, 8} and language == exact == near
    left = dict(x for x in repeats if x[0] in (7, 8))
    assert passage not in left[7] + left[8]
    # Characters of the documents' own stay, wherever nothing repeats.
    assert left[7].count("\ufffd") == 3 and left[8].count("\ufffd") == 1 and left[8].startswith("é")
    assert {r.doc_id for r in last} == {1, None, 6, 7, 8} and sum(r.length for r in last if r.doc_id == 6) == 4
    assert run_stages(spark, [])[1] == []


def test_stretches_widen_to_whole_characters():
    text = np.frombuffer("aé\U0001f600b".encode(), np.uint8)  # bytes 0, 1-2, 3-6, 7
    widened = suffix_dedup.to_characters(text, np.array([2, 4]), np.array([4, 5]))
    assert [x.tolist() for x in widened] == [[1, 3], [7, 7]]
    assert [x.tolist() for x in suffix_dedup.to_characters(text, np.array([0, 7]), np.array([1, 8]))] == [[0, 7], [1, 8]]
