"""Operator 12 against a trie made with dictionaries."""
import random
import zlib

import pytest

import fixtures as fx
from lakeweave.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, conv long, total long, key string, at int"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows: list[tuple]) -> list[tuple]:
    original: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            original.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in original.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, fx.sha(f"{len(t[1])}:{t[1]}{t[2]}".encode())[:32]))
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = original.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        rebuilt[c] = tuple((r, t) for _, r, t in donor[:h] + own[h:])
    members: dict = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids: dict = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) + (not below)
        saved[node] = sum(saved[k] for k in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    out = []
    for node, m in members.items():
        ends = sorted(c for c in m if len(rebuilt[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), leaves[node],
                    saved[node], fx.sha(",".join(map(str, ends)).encode())))
    return out


def check(spark, tmp, rows, partitions=3):
    table = spark.createDataFrame([(*r, 1, 2, "k", 3) for r in rows], SCHEMA)
    table.repartition(partitions).write.parquet(f"{tmp}/conversations.parquet")
    got = [tuple(r[c] for c in NAMES) for r in pt.op12_prefix_trie(spark, tmp).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    return got


def conversations(rng, n, longest=8, texts=3):
    rows = []
    for c in rng.sample(range(-50, 4 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), "t" * rng.randrange(texts) + "é"))
    return rows


def test_awkward_rows(spark, tmp):
    rows = conversations(random.Random(1), 150)
    rows += [(None, 0, "user", "lost"), (700, None, None, None), (700, 2, "", "x"), (700, 2, "user", "x"), (700, 2, "user", "x"),
             (701, 5, "user", "long " * 9000), (702, None, "user", "a"), (702, None, "user", "b"), (703, 0, "user", ""), (900, 3, None, "z")]
    check(spark, tmp, rows)


def test_small_forests_and_a_hot_conversation(spark, tmp, monkeypatch):
    """Forests of few rows, so nearly every node crosses borders; a third of
    the conversations are equal, another third share their first turn."""
    rng = random.Random(2)
    rows = []
    for c in range(0, 400):
        kind = c % 3
        if kind == 0:
            rows += [(c, t, "user", f"same {t}") for t in range(4)]
        else:
            rows += [(c, t, "user", "same 0" if kind == 1 and t == 0 else f"w{rng.randrange(3)}") for t in range(rng.randint(1, 7))]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = check(spark, f"{tmp}/{size}", rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert max(r[3] for r in got) == 400


@pytest.mark.parametrize("size", ["3", "10000"])
def test_conversations_of_many_segments(spark, tmp, monkeypatch, size):
    """Long conversations: several segments, common beginnings within and
    beyond the first, one that ends where another goes on."""
    rng = random.Random(3)
    spine = [("user", f"s{rng.randrange(5)}") for _ in range(500)]
    rows = []
    for c, n in [(0, 500), (101, 200), (202, 200), (303, 64), (404, 128), (505, 129), (606, 65), (707, 63), (808, 10)]:
        turns = list(spine[:n])
        if c in (202, 606):
            turns[-3:] = [("user", "other")] * 3
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rows += [(900, t, "user", f"r{t % 7}") for t in range(300)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        check(spark, tmp, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_table(spark, tmp):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp}/conversations.parquet")
    assert pt.op12_prefix_trie(spark, tmp).collect() == []
