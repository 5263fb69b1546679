"""The pipeline against its operators one by one, and stages on edge rows."""

import corpus_pipeline
import numpy as np

from candlelake.llm import langid, mixing, suffix_array
from candlelake.llm.queries import LEAST_SCORE, TARGETS
from tests.llm.test_near_copies import slow_kept
from tests.llm.test_repeats import SCHEMA, corpus, frame, slow_bytes

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    documents = docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, SF_DIR).persist()
        assert out.schema.simpleString() == documents.schema.simpleString(), name
        before = {r.doc_id: r for r in docs.collect()}
        after = [r for r in out.collect()]
        assert {r.doc_id for r in after} <= set(before)
        if name == "language ID":
            found = {r.doc_id: r for r in langid.identify(docs).collect()}
            wanted = {d for d, r in found.items() if r.lang_pred != "und" and r.score >= LEAST_SCORE}
            assert {r.doc_id for r in after} == wanted
        if name == "SimHash near-dedup":
            kept, _ = slow_kept([(d, r.text) for d, r in before.items()])
            assert sorted(r.doc_id for r in after) == kept
        if name == "suffix-array dedup":
            wanted = {d: (n - gone) for d, n, gone, *_ in slow_bytes([(d, r.text) for d, r in before.items()], 200)}
            for r in after:
                assert wanted[r.doc_id] - 6 <= len(r.text.encode()) <= wanted[r.doc_id] and r.n_chars == len(r.text)
        if name == "mixing to target weights":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            copies = {r.doc_id: r.copies for r in mixing.mixing_rates(docs, labels, TARGETS).collect() if r.copies}
            got = {}
            for r in after:
                got[r.doc_id] = got.get(r.doc_id, 0) + 1
            assert got == copies
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_cut_repeats_keeps_other_columns(spark):
    rows = corpus(6)
    docs = frame(spark, rows)
    out = suffix_array.cut_repeats(docs)
    assert out.columns == docs.columns and docs.schema.simpleString() == out.schema.simpleString()
    assert out.count() == len(rows)
    assert {(r.th, r["at"], r.low) for r in out.collect()} == {("x", 1, 2)}
    assert suffix_array.cut_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row int, th string, did long, part int, score double, copies int"


def tables(spark, folder, rows):
    extra = (1, "t", 2, 3, 0.5, 9)
    docs = spark.createDataFrame([(*r, *extra) for r in rows], DOCUMENTS)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, int(r[0] % 9 == 0)) for r in rows if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_run_on_empty_tables(spark, tmp_path):
    docs = tables(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, str(tmp_path)).count() == 0


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, repeated ids, very long texts and columns with names that the operators use themselves."""
    rng = np.random.default_rng(3)
    words = {lang: [f"{stem}{i}" for i in range(300)] for lang, stem in (("en", "the"), ("de", "der"))}
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        text = " ".join(rng.choice(words[lang], 40))
        rows.append((i, text, lang, "hot", len(text)))
    long = " ".join(rng.choice(words["en"], 150_000))
    rows += [(100, long, "en", "hot", len(long)), (101, None, "en", None, None), (102, "", None, "x", 0), (None, " ".join(rng.choice(words["de"], 45)), "de", "x", 1)]
    rows += [(7, " ".join(rng.choice(words["en"], 50)), None, None, None), (7, rows[7][1], "en", "hot", 5)]
    docs = tables(spark, str(tmp_path), rows)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, str(tmp_path)).persist()
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        got = out.collect()
        if name == "language ID":
            # what has letters is known here, by either language
            assert {r.doc_id for r in got} == {r[0] for r in rows} - {101, 102}
        if name in ("SimHash near-dedup", "suffix-array dedup"):
            assert sum(r.doc_id == 7 for r in got) == 2 and any(r.doc_id is None for r in got)
            assert any(len(r.text) > 700_000 for r in got)
        assert {(r.row, r.th, r.did, r.part, r.score, r.copies) for r in got} == {(1, "t", 2, 3, 0.5, 9)}, name
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sum(p.length for p in pieces) > 100_000
