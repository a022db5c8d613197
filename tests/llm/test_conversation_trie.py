"""The prefix trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pulsetide.llm.conversation_trie import NOTHING, ordered_turns, rebuilt, trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def begun_alike(rows):
    """Every conversation's turns after rebuilding, as (role, text)."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[conv].append(((turn is not None, turn or 0), tie, len(text), role, text))
    said = {c: [(r[3], r[4]) for r in sorted(x)] for c, x in said.items()}
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = said.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    return out


def brute(said):
    members = defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        own = (len(who) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += own
    rows = []
    for path, who in members.items():
        ended = ",".join(str(c) for c in sorted(who) if len(said[c]) == len(path))
        rows.append((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children[path], leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(rows, key=repr)


def ours(spark, rows, block):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'x' AS node")
    return sorted((tuple(r) for r in trie(*rebuilt(ordered_turns(frame)), block).select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("block", [1, 3, 8])
def test_equals_plain_python(spark, block):
    rng = random.Random(block)
    rows = []
    for conv in [*range(0, 12), *range(95, 130), *range(300, 312), -101, -100, -7, 2**40]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 30])):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["ab", "é\U0001f600", "", None, "c"]) if turn > 9 else "same"))
    rows += [(None, 1, "user", "lost"), (5, None, "a", "first"), (5, None, "b", "first"), (5, 3, "user", "tie"), (5, 3, "user", "tie")]
    rows += [(700, 0, "user", "x" * 70_000), (701, 0, "user", "x" * 70_000), (700, 1, "us", "er"), (701, 1, "use", "r")]
    rows += [(c, 0, "user", "alone") for c in range(801, 812)]
    want = brute(begun_alike(rows))
    assert ours(spark, rows, block) == want
    # Only heads of the first of the hundred, none of them present, leave a turnless conversation.
    assert any(not x for x in begun_alike(rows).values())


def test_one_conversation_holds_most_turns(spark):
    rows = [(0, i, "user", f"turn {i % 7}") for i in range(900)] + [(c, i, "user", f"turn {i % 7}") for c in range(1, 40) for i in range(4)]
    assert ours(spark, rows, 8) == brute(begun_alike(rows))


def test_conversations_that_all_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr("pulsetide.llm.conversation_trie.CHUNK", 100)
    rows = [(c, i, "user", "hello") for c in range(0, 100_000, 100) for i in range(2)]
    got = ours(spark, rows, 8)
    assert got == brute(begun_alike(rows)) and len(got) == 3 and got[0][-1] == got[1][-1] == NOTHING


def test_empty_table(spark):
    assert ours(spark, [], 8) == []
    assert ours(spark, [(None, 1, "user", "x")], 8) == []
