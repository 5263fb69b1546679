"""Language identification: held-out accuracy, calibration, and edge rows."""

import zlib

import numpy as np

from candlelake.llm import langid, stages
from candlelake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"


def test_held_out_accuracy_and_calibration(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == truth[r.doc_id] for r in out])
    assert right > 0.95
    assert abs(np.mean([r.score for r in out]) - right) < 0.05
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    english, german = "the cat and the dog were here ", "der hund und die katze waren hier "
    rows = [(i, (english, german)[i % 2] * (1 + i % 3), ("en", "de")[i % 2], "x", 1) for i in range(80)]
    rows += [(100, None, "en", "", 0), (101, "", "de", "", 0), (102, "12 ?! ½", None, "", 0)]
    rows += [(103, german * 60_000, None, "", 0), (None, english, "de", "", 0), (104, english, None, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[103].lang_pred == "de" and got[104].lang_pred == "en"
    assert got[None].lang_pred == "en" and got[None].held_out
    kept = langid.keep_identified(docs, 0.3)
    assert kept.columns == docs.columns
    assert {100, 101, 102} & {r.doc_id for r in kept.collect()} == set()


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None, "", 0)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def test_label_does_not_reach_predictions(spark):
    rows = [(i, f"{'abc' if i % 2 else 'xyz'} word {i}", ("en", "de")[i % 2], "", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.train(docs)
    bare = docs.selectExpr("doc_id", "text")
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.drop("score", "lang_pred"), model).collect()}
    assert one == {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(bare, model).collect()}


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "héllo wörld " * 50
    whole = langid.counts_of(text)
    monkeypatch.setattr(langid, "_CHUNK", 7)
    assert (langid.counts_of(text) == whole).all() and whole.sum() == 3 * len(text) - 3


def test_l1_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = [(rng.choice(1 << 12, 40, replace=False), np.full(40, 0.15), i % 2) for i in range(60)]
    rows = [(np.append(f, 5000 + c), np.append(v, 0.5), c) for f, v, c in rows]
    w, _ = langid.fit_weights(rows, 2)
    assert (w == 0).mean() > 0.5 and w[5000, 0] > 0 > w[5000, 1]


def test_sample_is_bounded_when_an_id_repeats(spark, monkeypatch):
    """An id that a third of the rows share brings no more rows into the fitting task than the bound."""
    monkeypatch.setattr(langid, "MOST_TRAINING", 20)
    seen = []
    monkeypatch.setattr(langid, "map_arrow", lambda df, f, schema: seen.append(df.count()) or stages.map_arrow(df, f, schema))
    rows = [(1, "same words here", "en")] * 200 + [(1, f"other words {i}", "en") for i in range(100)] + [(i, f"das ist {i}", "de") for i in range(300)]
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert seen and max(seen) <= 20


def test_keep_identified_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, _score string, score double"
    assert langid.keep_identified(spark.createDataFrame([], schema), 0.3).count() == 0
    rows = [(i % 40, ["the cat and the dog", "der hund und die katze"][i % 2] * 3, ["en", "de"][i % 2], "s", 0.1) for i in range(200)]
    rows += [(500, None, "en", None, None), (501, "", "en", None, None), (502, "12 34", None, None, None), (None, "the cat and the dog", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    kept = langid.keep_identified(docs, 0.3)
    assert kept.schema == docs.schema
    got = kept.collect()
    assert not {500, 501, 502} & {r.doc_id for r in got} and sum(r.doc_id is None for r in got) == 1 and len(got) == 201
