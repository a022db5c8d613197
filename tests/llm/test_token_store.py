"""The token store against plain Python, and its index and files on their own."""

import json
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsetide.llm import token_store
from pulsetide.llm.registry import QUERIES
from pulsetide.llm.token_store import PerfectHash, look_up, position, write_store

SMALL = "/root/testdata/sf0.001"
DESCRIBED = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).to_str()
LIBRARY = Tokenizer.from_str(DESCRIBED)
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def ids_of(text, end=1):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [end]


def found(spark, path, keys):
    return [(r.key, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in look_up(spark, path, keys).collect()]


def in_order(spark, rows, end=1):
    """Rows of (key, text) as the store orders them, with the ids before each."""
    hashes = spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("xxhash64(CAST(t AS binary)) AS h").collect()
    order = sorted((key is None, key if key is not None else 0, len((text or "").encode()), h, ids_of(text, end)) for (key, text), (h,) in zip(rows, hashes))
    starts = np.cumsum([0, *(len(r[-1]) for r in order)]).tolist()
    return [(None if r[0] else r[1], start, r[-1]) for r, start in zip(order, starts)]


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {
        (key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for key, start, ids in in_order(spark, [(r.doc_id, r.text) for r in docs])
    }
    got = QUERIES["op11_token_store"](spark, SMALL).collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == want


def test_repeats_nulls_and_long_texts_over_many_shards(spark, tmp_path):
    rows = [(7, "seven"), (7, "seven"), (7, None), (-3, ""), (None, "none"), (None, None), (2**62, LONG), (0, "zero 0!")]
    rows += [(5, f"hot {i % 3}") for i in range(400)] + [(i, f"doc {i}") for i in range(100, 300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ids", "1 AS shard", "2 AS key")
    path = str(tmp_path / "store")
    write_store(frame, DESCRIBED, path, shard_bytes=100)
    want = in_order(spark, rows)
    assert sorted(found(spark, path, frame), key=repr) == sorted(want, key=repr)
    # The hot key lies in several shards, and the payload is the ids in order and nothing else.
    names = sorted(os.listdir(tmp_path / "store/ids"))
    hot = look_up(spark, path, spark.createDataFrame([(5,)], "doc_id long"))
    assert len({r.shard for r in hot.collect()}) > 1 and not [n for n in names if n.startswith(".s") and not n.endswith(".crc")]
    payload = b"".join((tmp_path / "store/ids" / n).read_bytes() for n in names if n.endswith(".bin"))
    assert np.frombuffer(payload, "<u2").tolist() == [i for *_, ids in want for i in ids]
    sizes = spark.read.parquet(f"{path}/shards").orderBy("shard").collect()
    assert sum(r.docs for r in sizes) == len(rows) and sizes[0].first_id == 0
    assert all(b.first_id == a.first_id + a.ids for a, b in zip(sizes, sizes[1:]))
    with pytest.raises(ValueError, match="exists"):
        write_store(frame, DESCRIBED, path)


def test_absent_keys_and_repeated_questions(spark, tmp_path):
    path = str(tmp_path / "store")
    write_store(spark.range(0, 4000, 2).selectExpr("id AS doc_id", "concat('t', id) AS text"), DESCRIBED, path)
    asked = spark.createDataFrame([(k,) for k in (6, 6, 7, 9, -1, 3998, 4000, None)], "k long")
    got = look_up(spark, path, asked, key="k").collect()
    assert sorted(r.key for r in got) == [6, 3998]
    odd = spark.range(1, 400_000, 2)
    assert look_up(spark, path, odd, key="id").count() == 0


def test_text_keys_wide_vocabularies_and_end(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    rows = [("a", "one"), ("b", "two"), ("a", "three four"), (None, "five")]
    frame = spark.createDataFrame(rows, "url string, body string")
    write_store(frame, DESCRIBED, path, end=70_000, text="body", key="url")
    assert json.loads((tmp_path / "store/store.json").read_text())["width"] == 4
    asked = spark.createDataFrame([("a",), (None,), ("c",)], "url string")
    got = sorted((r.key or "", np.frombuffer(r.ids, "<u4").tolist()) for r in look_up(spark, path, asked, key="url").collect())
    assert got == sorted([("a", ids_of("one", 70_000)), ("a", ids_of("three four", 70_000)), ("", ids_of("five", 70_000))])


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id long, text string")
    write_store(frame, DESCRIBED, str(tmp_path / "store"))
    assert look_up(spark, str(tmp_path / "store"), spark.range(5), key="id").count() == 0
    assert spark.read.parquet(str(tmp_path / "store/shards")).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for count in (0, 1, 2, 63, 64, 65, 50_000):
        one = np.arange(count).astype(np.uint64)
        two = rng.integers(0, 2**63, count).astype(np.uint64)
        made = PerfectHash.build(one, two)
        assert sorted(made.slots(one, two).tolist()) == list(range(count))
    # About 3.7 bits a key, and few levels: a look-up reads one or two of them.
    assert made.sizes.sum() < 4.2 * count and (made.slots(one, two) >= 0).all()
    with pytest.raises(ValueError, match="in common"):
        PerfectHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))
    assert position(one[:5], two[:5], 0, np.int64(64)).max() < 64


def test_a_repeated_task_changes_nothing(tmp_path):
    from pyarrow import fs

    for data in (b"abc", b"abc"):
        out = token_store.Replaced(fs.LocalFileSystem(), f"{tmp_path}/shard")
        out.write(data)
        out.close()
    assert os.listdir(tmp_path) == ["shard"] and (tmp_path / "shard").read_bytes() == b"abc"


def test_reads_lie_close_together():
    begins, ends = np.array([0, 10, 500, 505]), np.array([10, 20, 504, 5000])
    assert list(token_store.close(begins, ends, 100, 50)) == [(0, 2), (2, 3), (3, 4)]
