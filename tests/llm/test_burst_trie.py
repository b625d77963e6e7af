import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from groundsheet.llm import burst_trie

KINDS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Nodes by dictionaries over all prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, len(text.encode().split())))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, words = {}, {(): 0}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        told = own.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:]
        for d in range(len(told) + 1):
            path = tuple(t[0] for t in told[:d])
            members.setdefault(path, []).append((conv, d == len(told)))
            if d:
                words[path] = told[d - 1][1]
    kids, leaves, saved = {}, {}, {}
    for path in members:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    for path, found in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] = saved.get(path[:d], 0) + (len(found) - 1) * words[path]
            if path not in kids:
                leaves[path[:d]] = leaves.get(path[:d], 0) + 1
    out = []
    for path, found in members.items():
        ends = ",".join(str(c) for c, end in sorted(found) if end)
        parent = min(members[path[:-1]])[0] if path else None
        out.append((min(found)[0], len(path), parent, len(found), kids.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(*burst_trie.NODE).collect()), key=repr)


def random_rows(seed, conversations=150, words=3, longest=12):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        # few different turns, so paths are shared, end inside others and repeat
        for turn in range(draw.randrange(1, longest)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), " ".join(draw.choice("ab") for _ in range(draw.randrange(words)))))
    return rows


@pytest.mark.parametrize(("container", "segment"), [(256, 64), (2, 64), (1, 3), (5, 1)])
def test_random_conversations(spark, container, segment):
    rows = random_rows(container)
    assert result(burst_trie.prefix_trie(spark.createDataFrame(rows, KINDS), container=container, segment=segment)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (0, None, "user", None), (0, 2, None, "b"), (0, 1, "user", "a  b\n\x0bc"), (0, 1, "user", "a  b\n\x0bc"),
        (1, 0, "user", ""), (1, None, None, None), (3, 0, "", "x"), (41, 5, "user", "only turn"), (44, 5, "user", "only turn"), (-1, 0, "u", "y"), (-20, 0, "u", "y z"),
        (60, 0, "user", "w " * 200_000), (61, 0, "user", "w " * 200_000), (62, 7, "1:", "a"), (63, 7, "1", ":a"),
    ] + [(100 + k, t, "user", f"same {t}") for k in range(30) for t in range(4)]
    df = spark.createDataFrame(rows, KINDS)
    assert result(burst_trie.prefix_trie(df, container=2, segment=2)) == plain(rows)
    extra = df.select("*", *(F.lit("x").alias(c) for c in ("pos", "id", "words", "head", "n", "seg", "lent", "family", "depth")))
    assert result(burst_trie.prefix_trie(extra)) == plain(rows)
    assert result(burst_trie.prefix_trie(df.limit(0))) == []
    turnless = [(c, 0, "user", "gone") for c in (41, 44) if zlib.crc32(str(c).encode()) % 4]
    assert result(burst_trie.prefix_trie(spark.createDataFrame(turnless, KINDS))) == plain(turnless)


def test_long_conversation_and_copies(spark):
    """One conversation of 700 turns, others that leave it at every place, and copies beyond every container."""
    rows = [(0, t, "user", f"t{t % 3}") for t in range(700)]
    rows += [(20 * k, t, "user", f"t{t % 3}" if t < 7 * k else "own") for k in range(1, 90) for t in range(7 * k + 1)]
    rows += [(5000 + 20 * k, t, "user", f"copy {t}") for k in range(400) for t in range(3)]
    df = spark.createDataFrame(rows, KINDS)
    assert result(burst_trie.prefix_trie(df, container=8, segment=16)) == plain(rows)
