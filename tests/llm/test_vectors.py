"""Search against brute force: recall, exact scores, ties, edge rows."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlelake.llm import vectors
from candlelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, list int"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        scores = x @ x[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))
        out[q] = [(ids[i], scores[i]) for i in order[:k]]
    return out


def compare(rows, wanted):
    """Recall, with scores checked on the way."""
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(wanted)
    hits = total = 0
    for q, best in wanted.items():
        assert len(got[q]) == len(best)
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        hits += len({v for v, _ in got[q]} & {v for v, _ in best})
        total += len(best)
    return hits / total


def test_recall_on_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in table], np.array([r.embedding for r in table], float)
    rows = QUERIES["op7_nearest_vectors"](spark, sf_dir).collect()
    wanted = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert compare(rows, wanted) >= 0.9
    of = dict(zip(ids, x))
    assert all(abs(r.score - of[r.query_id] @ of[r.vec_id]) < 1e-12 for r in rows)


def test_lengths_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 9)) * rng.uniform(0.1, 4, (400, 1))
    x[100:200] = x[100]
    x = x.astype(np.float32).astype(float)
    ids = [int(i) for i in rng.permutation(400)]
    rows = [(i, v.tolist(), 0, "x", 1) for i, v in zip(ids, x)]
    table = vectors.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    got = vectors.search(table, table.where("vec_id % 20 = 0"), k=20, lists=20, recall=1.0).collect()
    wanted = brute(ids, x, [i for i in range(0, 400, 20)], 20)
    assert compare(got, wanted) > 0.97


def test_unusable_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0 + i, 2.0, 0.5]) for i in range(10)]
    bad = [(20, None), (21, [0.0] * 3), (22, [1.0, nan, 0.0]), (23, [inf, 1.0, 1.0]), (24, [1.0, None, 2.0]), (26, [])]
    rows = [(i, v, 0, "x", 1) for i, v in good + good[:2] + bad + [(None, [1.0] * 3)]]
    docs = spark.createDataFrame(rows, SCHEMA)
    table = vectors.usable(docs, "vec_id", "embedding")
    assert sorted(r.vec_id for r in table.collect()) == list(range(10))
    got = vectors.search(table, table.where("vec_id % 20 = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [9, 8, 7, 6, 5, 4, 3, 2, 1] and got[0].query_id == 0
    empty = vectors.usable(docs.where("false"), "vec_id", "embedding")
    assert vectors.search(empty, empty).count() == 0 and vectors.search_lengths(empty, F.lit(True)).count() == 0
    one = table.where("vec_id = 0")
    assert vectors.search(one, one).count() == 0


def test_lengths_and_repeated_ids_all_take_part(spark):
    """Vectors are compared within their length; differing vectors of one id are rows of their own."""
    rng = np.random.default_rng(7)
    rows = [(i % 60, rng.standard_normal(size).tolist()) for i in range(120) for size in (3, 5)] + [(20, [2.5])]
    rows += rows[:30]  # exact repeats are one
    table = vectors.usable(spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, label int, vec string, list int"), "vec_id", "embedding")
    assert table.count() == 241
    got = vectors.search_lengths(table, F.expr("vec_id % 20 = 0"), 20, recall=1.0).collect()
    of = {(r.vec_id, r.variant): np.array(r.vec) for r in table.collect()}
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault((r.query_id, r.query_variant), []).append((r.vec_id, r.variant, r.score))
    queries = {q: x for q, x in of.items() if q[0] % 20 == 0 and len(x) > 1}
    assert set(found) == set(queries) and len(queries) == 12
    for q, x in queries.items():
        others = [(-float(x @ y), *key) for key, y in of.items() if key != q and len(y) == len(x)]
        best = sorted(others)[:20]
        assert [(i, v) for i, v, _ in found[q]] == [(i, v) for _, i, v in best]
        assert np.allclose([s for _, _, s in found[q]], [-s for s, _, _ in best], atol=1e-12)


@pytest.mark.parametrize("n", [500, 4_000, 20_000])
def test_recall_where_lists_are_full(spark, n):
    """Unit vectors without structure: no query scans all lists, and recall stays above 0.9."""
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}))
    table = vectors.usable(frame, "vec_id", "embedding")
    got = vectors.search(table, table.where(f"vec_id % {n // 100} = 0")).select("query_id", "vec_id").collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, n, n // 100):
        scores = x @ x[q]
        scores[q] = -9
        assert len(found[q]) == 20
        hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    print(n, hits / 2000)
    assert hits / 2000 >= 0.9


def test_clustered_vectors_need_few_lists(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16)) * 5
    x = centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 16)) * 0.1
    table = vectors.usable(spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(4000), "embedding": x.tolist()})), "vec_id", "embedding")
    space = vectors.fit(table, 60)
    near = lambda b: iter([pa.RecordBatch.from_arrays([*b.columns, pa.array(space.lists(space.rotated(vectors._matrix(b["vec"], 16), False), 1)[:, 0])], names=[*b.schema.names, "list"])])
    filed = vectors.map_arrow(table, near, "vec_id long, variant long, vec array<double>, list long")
    assert vectors._needed(filed, table, space, 20, 0.95) <= 6


def test_probes_stay_below_their_share():
    rng = np.random.default_rng(2)
    space = vectors.Space(8, 9.0, np.linalg.qr(rng.standard_normal((9, 9)))[0], rng.standard_normal((40, 9)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50)), pa.array(list(rng.standard_normal((50, 8))), pa.list_(pa.float64()))], names=["query_id", "vec"]
    )
    (out,) = vectors._probes(np.full(40, 50), 20, 20, space)(batch)
    assert {len(x) for x in out["lists"].to_pylist()} == {20} and set(out["first"].to_pylist()) == {1}
    # small lists: as many first lists as hold more than k, beyond the share if they must
    (out,) = vectors._probes(np.full(40, 1), 30, 20, space)(batch)
    assert {len(x) for x in out["lists"].to_pylist()} == {31} and set(out["first"].to_pylist()) == {31}
    (out,) = vectors._probes(np.full(40, 1), 90, 20, space)(batch)
    assert {len(x) for x in out["lists"].to_pylist()} == {40} and set(out["first"].to_pylist()) == {40}


def test_abandoning_keeps_the_nearest():
    rng = np.random.default_rng(1)
    space = vectors.Space(63, 9.0, np.linalg.qr(rng.standard_normal((64, 64)))[0], np.zeros((1, 64)))
    rows, queries = rng.standard_normal((500, 63)), rng.standard_normal((20, 63))
    turned, asked = space.rotated(rows, False), space.rotated(queries, True)
    far = ((asked[:, None] - turned[None]) ** 2).sum(2)
    beat = np.sort(far, 1)[:, 9]
    columns = [turned[:, i : i + 16] for i in range(0, 64, 16)]
    a, b = vectors._survivors(columns, asked, beat)
    found = set(zip(a.tolist(), b.tolist()))
    assert all(far[i, j] <= beat[i] * (1 + 1e-6) for i, j in found)
    wanted = {(i, j) for i in range(20) for j in np.flatnonzero(far[i] <= beat[i])}
    assert len(found & wanted) >= 0.97 * len(wanted)
