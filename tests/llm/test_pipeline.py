"""The pipeline, stage by stage, on the table with all awkward cases."""
import fixtures as fx

import __spark_entry__ as E
import corpus_pipeline as P
from lakeweave.llm import registry
from lakeweave.llm.common import staged


def test_stage_names_and_registration():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "suffix_dedup", "packing"]
    assert {"pipeline", *registry.QUERIES} <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_stages(spark, corpus, data):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = staged(stage(spark, docs, corpus), "test")
        assert docs.columns == columns
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert all(fx.WORD.search(r.text) and r.n_chars == len(r.text) for r in docs.collect())
    texts = {r[0]: r[1] for r in data}
    # rejected: null, empty, blank, symbols only
    assert not {3, 4, 5, 60} & set(seen["language_id"]) and {0, 1, 2, 6, 8, 9, None} <= set(seen["language_id"])
    # boilerplate lines go, documents stay
    assert set(seen["line_dedup"]) == set(seen["language_id"])
    assert not any("Licensed under" in r.text for r in seen["line_dedup"].values())
    # one document of each group stays
    assert not {1, 2, 63} & set(seen["near_dedup"]) and {0, 62, 9, None} <= set(seen["near_dedup"])
    # exact repeats are judged on the input of the stage
    left = seen["near_dedup"]
    want = fx.repeats([(i if i is not None else -10 ** 9, r.text) for i, r in left.items()])
    for i, r in seen["suffix_dedup"].items():
        assert fx.sha(r.text.encode()) == want[i if i is not None else -10 ** 9][3]
    assert texts[0] == seen["suffix_dedup"][0].text
    packed = P.STAGES[-1][1](spark, docs, corpus).collect()
    assert {r.doc_id for r in packed} == set(seen["suffix_dedup"])


def test_run_and_empty_table(spark, corpus, empty):
    rows = P.run(spark, corpus).collect()
    assert rows and len({(r.doc_id, r.start) for r in rows}) == len(rows)
    assert P.run(spark, empty).collect() == []


def test_several_texts_of_one_id_stay(spark, corpus):
    import random
    rng = random.Random(21)
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    one = docs.filter("doc_id = 0").first()
    texts = [fx.prose(rng, 120), fx.prose(rng, 120)]
    rows = [(7, t, *one[2:]) for t in texts] + [(7, texts[0], *one[2:]), (8, fx.prose(rng, 90), *one[2:]), (9, texts[1], *one[2:])]
    kept = P.drop_near_duplicates(spark, spark.createDataFrame(rows, docs.schema), corpus).collect()
    assert sorted(r.text for r in kept) == sorted([*texts, rows[3][1]])


def test_near_duplicates_join_texts_once(spark, corpus, monkeypatch):
    # the operator reads its input several times: it must be the written table, not the join that tells the ids
    seen, classes = [], P.weighted_minhash.classes
    monkeypatch.setattr(P.weighted_minhash, "classes", lambda df, **k: seen.append(df) or classes(df, **k))
    P.drop_near_duplicates(spark, spark.read.parquet(f"{corpus}/documents.parquet"), corpus).collect()
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
