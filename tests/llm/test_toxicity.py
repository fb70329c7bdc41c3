"""Operator 11: held-out accuracy, the label model against one on single rows, awkward rows."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import fixtures as fx
from lakeweave.llm import textbytes as tb
from lakeweave.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Toxic English texts hold listed insults, German ones words of an
    unknown stem; a third of all rows are copies of one clean text."""
    rng = random.Random(4)
    rows, labels = [], []
    hot = fx.prose(rng, 80)
    for i in range(900):
        lang = "de" if i % 4 == 0 else "en"
        w = fx.words(rng, rng.randint(40, 120), lang)
        toxic = int(i % 3 != 0 and rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["Stupid", "worthless,", "TRASH"]) if lang == "en" else "quarbel" + rng.choice(["t", "ung", "en"])
        rows.append((i, hot if i % 3 == 0 else " ".join(w), lang, "a", 1, *fx.CLASH))
        if rng.random() < 0.7:
            labels.append((i, 1, toxic))
    rows += [(1000, None, None, None, None, *fx.CLASH), (1001, "", None, None, 0, *fx.CLASH), (None, "stupid worthless trash", None, None, 1, *fx.CLASH),
             (1002, " \n123 ", None, None, 1, *fx.CLASH), (5, rows[5][1], "en", "a", 1, *fx.CLASH), (1003, "trash " * 20_000, "en", "a", 1, *fx.CLASH)]
    labels += [(None, 1, 1), (7, 1, None), (1, 0, 0), (1, 0, 1)]
    folder = fx.write(spark, str(tmp_path_factory.mktemp("toxic")), rows)
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return folder, rows, {i: t for i, _, t in labels if i is not None}


def test_held_out_accuracy(spark, table):
    folder, rows, labels = table
    got = tx.op11_toxicity(spark, folder).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and held(r.doc_id))
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    truth = {r[0]: int(any(w in r[1].lower() for w in ("stupid", "worthless", "trash", "quarbel"))) for r in rows if r[0] is not None and r[1]}
    for lang in ("en", "de"):
        ids = [r[0] for r in rows if r[0] is not None and r[0] < 900 and r[2] == lang and held(r[0])]
        right = [by_id[i].predicted == truth[i] for i in ids]
        caught = [by_id[i].predicted for i in ids if truth[i]]
        assert np.mean(right) > 0.97 and len(caught) > 5 and np.mean(caught) > 0.9
    assert by_id[1000].predicted == by_id[1001].predicted == by_id[1002].predicted == 0
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score and by_id[None].predicted == 1 and by_id[1003].predicted == 1


def test_labels_of_held_out_rows_are_not_read(spark, table):
    folder, rows, labels = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = spark.read.parquet(f"{folder}/labels.parquet")
    turned = known.withColumn("toxic", tx.F.when(tx.held_out(tx.F.col("doc_id")), 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    a, b = tx.fit(docs, known), tx.fit(docs, turned)
    assert np.allclose(a.word_weight, b.word_weight) and np.allclose(a.vote_weight, b.vote_weight) and abs(a.bias - b.bias) < 1e-9


def test_without_labels(spark, table):
    folder, rows, _ = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = tx.score(docs, tx.fit(docs, spark.createDataFrame([], LABELS))).collect()
    by_id = {r.doc_id: r.score for r in out}
    clean = [by_id[i] for i in range(1, 900) if i % 4 and not any(w in rows[i][1].lower() for w in ("stupid", "worthless", "trash"))]
    toxic = [by_id[i] for i in range(1, 900) if i % 4 and any(w in rows[i][1].lower() for w in ("stupid", "worthless", "trash"))]
    assert max(clean) < min(toxic)


def test_empty_tables(spark, tmp):
    fx.write(spark, tmp, [])
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp}/labels.parquet")
    assert tx.op11_toxicity(spark, tmp).collect() == []


def test_label_model_on_patterns_equals_rows():
    """Counts of patterns give the estimates of single rows; accuracies and the
    correlated pair of planted voters are found."""
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.15
    votes = np.zeros((6000, 5), np.int64)
    for v, (hit, false) in enumerate([(0.8, 0.02), (0.7, 0.01), (0.6, 0.05), (0.5, 0.02)]):
        votes[:, v] = rng.random(6000) < np.where(y, hit, false)
    votes[:, 4] = np.where(rng.random(6000) < 0.9, votes[:, 2], 0)          # a near copy of the third voter
    votes[:, 0] = np.where(votes[:, 0] == 0, -(rng.random(6000) < 0.5).astype(int), 1)
    post, m = tx.label_model(votes, np.ones(6000))
    code, first, count = np.unique(tx.encode(votes), return_index=True, return_counts=True)
    again, _ = tx.label_model(tx.decode(code, 5), count.astype(float))
    assert np.allclose(again, post[first], atol=1e-6)
    assert m.parent[4] == 2 or m.parent[2] == 4
    assert ((post > 0.5) == y).mean() > 0.95 and abs(m.prior - 0.15) < 0.04
    assert abs(m.accuracy[1] - votes[y, 1].sum() / votes[:, 1].sum()) < 0.06


def test_tokens_and_stems():
    b, off = tb.flat(pa.array(["Über-QUARBELT x", "quarbelung"]))
    t = tx.Tokens(b, off)
    assert t.doc.tolist() == [0, 0, 0, 1]
    stems = {}
    for token, h in t.parts():
        for i, x in zip(token, h):
            stems.setdefault(int(x), set()).add(int(i))
    assert sum(v == {1, 3} for v in stems.values()) == 4                    # the beginnings of 4 to 7 bytes
