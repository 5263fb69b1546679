"""Exact copies against a plain dictionary, with edge rows."""

import hashlib
import re

import numpy as np

from candlelake.llm import exact_copies

SCHEMA = "doc_id long, text string, length int, digest string, at int, passes boolean, row int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2, False, 3) for d, t in rows], SCHEMA).repartition(5)


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def compare(spark, rows):
    members = {}
    for d, t in rows:
        members.setdefault(digest(t), []).append(d)
    out = exact_copies.groups(frame(spark, rows), digests=True).collect()
    assert sorted([(r.doc_id is None, r.doc_id, r.text_sha256) for r in out], key=str) == sorted(
        [(d is None, d, digest(t)) for d, t in rows], key=str
    )
    kept = {}
    for r in out:
        own = members[r.text_sha256]
        named = [d for d in own if d is not None]
        assert r.group_size == len(own) and r.keep_id == (min(named) if named else None)
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + 1
    assert kept == dict.fromkeys(members, 1)  # exactly one row of every text
    return out


def edge_rows():
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(rng.choice(["ab", "cd", "é", "日本"], rng.integers(0, 4)))) for i in rng.permutation(300)]
    head = "same start " * 20
    rows += [(1000, head + "aa"), (1001, head + "bb"), (1002, head + "aa"), (1003, head + "cc")]  # equal length and prefix
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "\t\n\x0b"), (2004, "\xa0"), (2005, "\x85")]
    rows += [(None, "lone"), (None, "a  b"), (7, "a b"), (7, "a\nb"), (7, "another text"), (None, None), (None, "only nulls"), (None, "only nulls")]
    long = "x y " * 300_000
    rows += [(3000, long), (3001, long.replace(" ", "\n\n")), (3002, long[:-1] + "z")]
    return rows


def test_edges(spark):
    compare(spark, edge_rows())


def test_hot_group(spark):
    """A third of all rows equal, and a third of another length class."""
    rows = [(i, "hot text") for i in range(700)] + [(700 + i, f"t{i:06d}") for i in range(700)] + [(1400 + i, "u" * (i + 20)) for i in range(700)]
    out = compare(spark, rows)
    assert sum(r.group_size == 700 for r in out) == 700


def test_small_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_copies, "FILTER_WORDS", 1)
    compare(spark, edge_rows())


def test_lone_texts_are_not_hashed(spark):
    rows = [(i, "w" * (i + 1)) for i in range(50)] + [(100, "w"), (101, "q" * 80 + "a"), (102, "r" * 80 + "a")]
    out = exact_copies.groups(frame(spark, rows)).collect()
    assert {r.doc_id for r in out if r.text_sha256} == {0, 100}


def test_keep_one(spark):
    docs = frame(spark, edge_rows())
    kept = exact_copies.keep_one(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    wanted = {}
    for d, t in edge_rows():
        wanted.setdefault(digest(t), []).append(d)
    assert {digest(r.text): r.doc_id for r in rows} == {
        k: min((d for d in ds if d is not None), default=None) for k, ds in wanted.items()
    }
    assert len(rows) == len(wanted) and {(r.length, r.digest, r["at"], r.passes, r.row) for r in rows} == {(1, "x", 2, False, 3)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_copies.groups(empty).count() == 0 and exact_copies.keep_one(empty).count() == 0
    assert exact_copies.groups(empty).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_plan_shuffles_no_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = exact_copies.groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan and "text#" not in plan
