"""Parts of the operators that need no Spark, against plain Python."""
import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

import fixtures as fx
from lakeweave.llm import byte_bpe, cross_polytope, language_id, packing, pieces, quality_votes, token_files, weighted_minhash
from lakeweave.llm import textbytes as tb
from lakeweave.llm.run_index import RunIndex

ODD = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", "'ll", "é", "ß", " ", "1", "23", ".", "!!", "　", "\x1c",
       "\x85", "漢字", "😀", "é", "<|endoftext|>", "\r\n", "\x0b", " hello", "World", "-", "_", "\x00"]


def odd_texts(n=1500, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", "   ", " \n ", "a" * 4000]


def test_words_and_shingles():
    texts = [t for _, t, *_ in fx.rows()] + odd_texts(200)
    data, off = tb.flat(pa.array(texts, pa.string()))
    w = tb.Words(data, off)
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in fx.WORD.findall(t or "")]
    h, doc, _ = tb.shingles(w, 5)
    want = [(i, s) for i, t in enumerate(texts) for s in fx.shingles(t).elements()]
    assert sorted(doc.tolist()) == sorted(i for i, _ in want)
    assert len(set(h.tolist())) == len({s for _, s in want})


def test_pieces_equal_whole_texts():
    texts = odd_texts()
    data, off = tb.flat(pa.array(texts, pa.string()))
    own = byte_bpe.codec(public_tokenizers.path(byte_bpe.VOCABULARY))
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids, begin = pieces.byte_ids(pieces.PieceCache(own.encode_pieces, limit=50), data, off)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [exact.encode_ordinary(t) for t in texts]
    back, at = own.decode(ids.astype(np.int64), begin)
    assert [back[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])] == texts
    path = public_tokenizers.path(token_files.VOCABULARY)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    ids, begin = pieces.word_ids(pieces.PieceCache(pieces.library_encoder(path)), data, off)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [
        e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_rank_queue_on_a_very_long_pre_token():
    own = byte_bpe.codec(public_tokenizers.path(byte_bpe.VOCABULARY))
    exact = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(2)
    for raw in ("a" * 50_000, "".join(rng.choice("abctheing") for _ in range(20_000))):
        assert own.merge(raw.encode()) == exact.encode_ordinary(raw)
    assert not any(own.low) and not any(own.mid) and not own.bucket      # the queue is empty again


def test_run_index_finds_all_repeats():
    rng = random.Random(3)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(40))
        texts = [base[x:x + rng.randint(5, 30)] if rng.random() < 0.5 else bytes(rng.choice(b"ab") for _ in range(rng.randint(5, 30)))
                 for x in (rng.randint(0, 20) for _ in range(rng.randint(1, 8)))]
        data, off = tb.flat(pa.array(texts, pa.binary()))
        got: dict = {}
        for t, s, c in zip(*RunIndex(data, off).classes(6)):
            got.setdefault(c, set()).add((t, s))
        want: dict = {}
        for i, t in enumerate(texts):
            for j in range(len(t) - 5):
                want.setdefault(t[j:j + 6], set()).add((i, j))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    copies = [base * 30] * 20
    data, off = tb.flat(pa.array(copies, pa.binary()))
    index = RunIndex(data, off)
    assert index.runs < index.n / 5                          # repetitive texts have few runs


def test_directly_addressable_codes():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 256, 3000), rng.integers(0, 70_000, 3000), [0, 255, 256, 2 ** 31 - 1]])
    rng.shuffle(ids)
    begin = np.array([0, 10, 10, 4000, len(ids)])
    f = token_files.TokenFile(token_files.image(77, np.array([3, 4, 0, 9]), np.array([False, False, True, False]), begin, ids))
    assert (f.start, f.n) == (77, len(ids)) and f.begin.tolist() == begin.tolist() and f.null.tolist() == [False, False, True, False]
    at = rng.integers(0, len(ids), 500)
    assert (f.get(at) == ids[at]).all()
    for i, j in ((0, len(ids)), (5, 6), (511, 1025), (4000, 4000)):
        assert (f.run(i, j) == ids[i:j]).all()
    assert token_files.TokenFile(token_files.image(0, *[np.zeros(0, np.int64)] * 2, np.zeros(1, np.int64), np.zeros(0, np.int64))).n == 0


def test_packing_plan_uses_each_remainder_once():
    rng = np.random.default_rng(4)
    for hist in ({}, {1: 3}, {1023: 50, 1: 10}, {512: 7}, dict(zip(*map(np.ndarray.tolist, np.unique(rng.integers(1, 1024, 20_000), return_counts=True)))),
                 {10: 100_000, 700: 3}):
        made = packing.plan(hist)
        used: dict = {}
        for lengths, n in made:
            assert n > 0 and sum(lengths) <= 1024
            for v in lengths:
                used[v] = used.get(v, 0) + n
        assert used == hist
    hist = dict(zip(*map(np.ndarray.tolist, np.unique(rng.integers(1, 1024, 50_000), return_counts=True))))
    n = sum(c for _, c in packing.plan(hist))
    assert sum(k * v for k, v in hist.items()) / (1024 * n) > 0.98


def test_least_squares_combinations():
    present = np.array([100, 300, 724, 512])
    combo = packing.combinations(present, 1024)
    assert {tuple(c) for c in combo.tolist()} == {(724, 300, 0), (512, 512, 0), (724, 200, 100)} - {(724, 200, 100)}
    count = np.zeros(1025)
    count[[724, 300, 512]] = 40, 40, 20
    x = dict(zip(map(tuple, combo.tolist()), packing.solve(combo, count)))
    assert abs(x[(724, 300, 0)] - 40) < 0.5 and abs(x[(512, 512, 0)] - 10) < 0.5


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(6)
    h = np.sort(rng.integers(1, 2 ** 63, 400).astype(np.uint64))
    x, y = slice(0, 320), slice(60, 400)
    w = rng.choice([1.0, 2.0, 3.7], 400)
    got = weighted_minhash.samples(np.concatenate([h[x], h[y]]), np.concatenate([w[x], w[y]]), np.array([0, 320, 660]), 2000)
    both = w[60:320].sum()
    assert abs((got[0] == got[1]).mean() - both / (w[x].sum() + w[y].sum() - both)) < 0.04
    heavy = weighted_minhash.samples(np.concatenate([h[:50], h[:50]]), np.concatenate([np.ones(50), np.full(50, 3.0)]), np.array([0, 50, 100]), 2000)
    assert abs((heavy[0] == heavy[1]).mean() - 1 / 3) < 0.04


def test_hadamard_rotations_keep_angles():
    x = cross_polytope.unit(np.random.default_rng(1).normal(size=(20, 48)))
    y = cross_polytope.rotate(x, cross_polytope.rotations(48, 2)[1])
    assert y.shape[1] == 64 and np.allclose(x @ x.T, y @ y.T)


def test_em_recovers_planted_quality():
    rng = np.random.default_rng(8)
    good = rng.random(20_000) < 0.8
    votes = np.zeros((20_000, quality_votes.N_RULES), int)
    for j in range(quality_votes.N_RULES):
        right, speaks = rng.random(20_000) < 0.9, rng.random(20_000) < 0.7
        votes[:, j] = np.where(speaks, np.where(right == good, 1, -1), 0)
    post, est = quality_votes.em(votes, np.ones(20_000))
    assert ((post >= 0.5) == good).mean() > 0.98 and abs(est["prior"] - 0.8) < 0.02
    assert quality_votes.unpack(np.array([0, 3 ** quality_votes.N_RULES - 1])).tolist() == [[-1] * 8, [1] * 8]


def test_language_model_and_rejection():
    rng = random.Random(4)
    texts, langs = zip(*[(fx.prose(rng, 40, lang), lang) for lang in ("en", "de") * 60])
    model = language_id.fit(list(texts), list(langs))
    fresh = [(fx.prose(rng, 40, lang), lang) for lang in ("en", "de") * 40]
    got, score = language_id.predict_batch(model, pa.array([t for t, _ in fresh]))
    assert np.mean([a == b for a, (_, b) in zip(got, fresh)]) > 0.97 and (score <= 1).all()
    assert language_id.fit([], []) is None


def test_votes_of_parts_keep_every_majority():
    """The merged vote names each place's token of more than half of the weight, however rows are dealt."""
    import random

    import pyarrow as pa

    from lakeweave.llm.line_templates import _tokens, _vote
    rng = random.Random(11)
    for _ in range(60):
        rows = []                                           # node, tokens, weight
        for node in range(rng.randint(1, 4)):
            width = rng.randint(1, 4)
            rows += [(node, [rng.choice([1, 1, 1, 2, 3]) * 10 + p for p in range(width)], rng.randint(1, 5)) for _ in range(rng.randint(1, 12))]
        rng.shuffle(rows)

        def vote(part):
            size = np.array([len(t) for _, t, _ in part], np.int64)
            weight = np.repeat(np.array([w for *_, w in part], np.int64), size)
            return _vote(np.array([n for n, *_ in part], np.int64), np.concatenate([np.array(t, np.int64) for _, t, _ in part]), size, weight)

        parts = [vote(p) for p in (rows[i::3] for i in range(3)) if p]
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        tokens, size = _tokens(table, "tokens")
        merged = _vote(table.column("node").to_numpy(), tokens, size, _tokens(table, "weights")[0])
        for node, got in zip(merged.column("node").to_pylist(), merged.column("tokens").to_pylist()):
            mine = [(t, w) for n, t, w in rows if n == node]
            for place, token in enumerate(got):
                total = sum(w for _, w in mine)
                for x in {t[place] for t, _ in mine}:
                    if 2 * sum(w for t, w in mine if t[place] == x) > total:
                        assert token == x


def test_a_hash_range_stays_small(spark):
    # a task that counts a range holds its hashes several times over: about a million shingles, whatever the input
    size = 60
    texts = spark.range(size).selectExpr("id AS doc_id", "repeat('abcde ', 200000) AS text")
    _, ranges = weighted_minhash._grouped(texts)
    assert size * 200_000 / ranges <= 1 << 20


def test_frequencies_come_back_in_the_order_sent(spark):
    h = [np.array(x, np.uint64) for x in ([3, 5, 9], [5], [1, 9, 2 ** 63])]
    n = [np.array(x, np.uint32) for x in ([1, 2, 1], [4], [1, 1, 7])]
    rows = [(0, g, weighted_minhash._packed(a), c.tobytes()) for g, (a, c) in enumerate(zip(h, n))]
    sent = spark.createDataFrame(rows, "part long, group long, hashes binary, n binary")
    got = {r.group: np.frombuffer(r.df, np.uint32).tolist() for r in weighted_minhash._frequencies(sent).collect()}
    assert got == {0: [1, 6, 2], 1: [6], 2: [1, 2, 7]}


def test_shingles_wanted_are_those_of_all():
    texts = [f"a b c d e f g h i a b c d e {i} x y z" for i in range(50)]
    data, off = tb.flat(pa.array(texts))
    h, count, at = weighted_minhash.weighted(data, off)
    assert all((np.diff(h[x:y].astype(object)) > 0).all() for x, y in zip(at, at[1:])) and count.max() == 2
    some = weighted_minhash.weighted(data, off, only=lambda h: h % np.uint64(3) == 0)
    pick = h % np.uint64(3) == 0
    assert (some[0] == h[pick]).all() and (some[1] == count[pick]).all()
