"""Operator 13 against a brute-force search for runs."""
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

import fixtures as fx
from lakeweave.llm import periodic_runs as pr


def runs(w: list, min_length: int = 24, min_exponent: int = 3) -> list[tuple]:
    """(start, length, period) of every run, period by period."""
    got = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                got.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in got.items())


def row(doc_id, text) -> tuple:
    w = fx.WORD.findall(text or "")
    n = len(w)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted(runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            fx.sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
            fx.sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode()))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def same(got, data):
    assert sorted(map(str, (tuple(r[c] for c in NAMES) for r in got))) == sorted(str(row(r[0], r[1])) for r in data)


def test_query(spark, corpus, data):
    got = pr.op13_periodic_runs(spark, corpus).collect()
    same(got, data)
    assert sum(r.n_runs > 0 for r in got) >= 3


def test_planted_and_natural_runs(spark, tmp):
    rng = random.Random(5)
    data = []
    for i in range(300):
        w = fx.words(rng, rng.choice([0, 3, 23, 24, 30, 90, 300]))
        if i % 3 == 0 and len(w) > 20:                      # overlapping runs of different periods
            w += (w[:5] * 7 + w[5:8] * 9 + w[:5] * 2) + ["x"] * rng.randint(20, 30)
        data.append((i, rng.choice([" ", "\n", " \t"]).join(w), "en", "a", 1, *fx.CLASH))
    got = pr.op13_periodic_runs(spark, fx.write(spark, tmp, data)).collect()
    same(got, data)
    assert sum(r.n_runs > 1 for r in got) > 50


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_of_small_alphabets(letters):
    """Many overlapping runs, other limits, several documents in a slice."""
    rng = random.Random(letters)
    for _ in range(40):
        docs = [[rng.randrange(letters) for _ in range(rng.choice([0, 1, 24, 70]))] for _ in range(4)]
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        for limits in ((24, 3), (4, 2), (6, 4)):
            found = pr.find_runs(np.array(sum(docs, []), np.int64), at, *limits)
            for d, w in enumerate(docs):
                assert sorted((int(s), int(n), int(q)) for k, s, n, q in zip(*found) if k == d) == runs(w, *limits)


def test_chunks_of_candidates(monkeypatch):
    """Chunks smaller than one period's grid give the same runs."""
    w = [i % 7 for i in range(200)] + [i % 3 for i in range(90)]
    want = pr.find_runs(np.array(w), np.array([0, len(w)]))
    monkeypatch.setattr(pr, "CHUNK", 5)
    got = pr.find_runs(np.array(w), np.array([0, len(w)]))
    assert [c.tolist() for c in got] == [c.tolist() for c in want] and len(got[0]) == 2


def test_grammar_extensions_are_exact():
    rng = random.Random(2)
    seq = [0] + [rng.randint(1, 2) for _ in range(400)] + [3]
    levels = pr.recompress(np.array(seq))
    pairs = [(x, y) for x in range(1, 401, 7) for y in range(x + 1, 401, 11)]
    x, y = (np.array(c) for c in zip(*pairs))
    for back in (False, True):
        got = pr.extend(levels, x, y, back)
        for k, (i, j) in enumerate(pairs):
            n = 0
            while (seq[i - 1 - n] == seq[j - 1 - n] if back else seq[i + n] == seq[j + n]):
                n += 1
            assert got[k] == n
