"""Integer clustering against all distances, with ties, empty clusters and odd rows."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlelake.llm import bisectors

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string, vec int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, "x", 1) for i, v in rows], SCHEMA).repartition(4)


def brute(rows, k, rounds, seed=2):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(col) // len(own[j]) for col in zip(*own[j])] if j in own else c for j, c in enumerate(centroids)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    return out, centroids


def compare(spark, rows, k=40, rounds=5):
    wanted, centroids = brute(rows, k, rounds)
    found, got = bisectors.cluster(bisectors.integers(frame(spark, rows), "vec_id", "embedding"), k, rounds)
    assert got == centroids
    assert sorted([tuple(r) for r in found.collect()], key=str) == sorted(wanted, key=str)
    return centroids


def test_random_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), (rng.standard_normal(64) * 0.1).tolist()) for i in rng.permutation(300)]
    bad = rows[0][1]
    rows += [(400, None), (401, []), (402, bad[:63]), (403, bad + [1.0]), (404, bad[:63] + [None])]
    rows += [(405, bad[:63] + [float("nan")]), (406, bad[:63] + [float("-inf")]), (407, [0.0] * 64), (408, [-0.0] * 64)]
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[11][1]), (None, rows[12][1]), (409, [1000.0, -1000.0] * 32)]
    compare(spark, rows)


def test_ties_and_empty_clusters(spark):
    """A third of the vectors equal, so that centroids start equal and all but the first of them stay empty."""
    rows = [(i, [0.5] * 64) for i in range(60)] + [(60 + i, [(i % 3) / 256] * 64) for i in range(60)] + [(120 + i, [i / 256] + [0.0] * 63) for i in range(60)]
    centroids = compare(spark, rows)
    assert len(centroids) == 40 and len({tuple(c) for c in centroids}) < 40


def test_fewer_vectors_than_clusters(spark):
    compare(spark, [(i, [i / 10] * 64) for i in range(7)])


def test_no_vectors(spark):
    assert bisectors.report(spark.createDataFrame([], SCHEMA)).count() == 0
    unnamed = bisectors.report(frame(spark, [(None, [0.1] * 64)])).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in unnamed] == [(None, None, None, None)]


def test_components_beyond_64_bits_are_refused(spark):
    rows = frame(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])
    with pytest.raises(Exception, match="do not fit 64 bits"):
        bisectors.report(rows).collect()


def test_report(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(120)]
    wanted, centroids = brute(rows, 40, 5)
    inertia = {}
    for _, c, d in wanted:
        inertia[c] = inertia.get(c, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    got = sorted(tuple(r) for r in bisectors.report(frame(spark, rows)).collect())
    assert got == sorted((i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, c, d in wanted)


vectors_ = st.lists(st.lists(st.integers(-4, 4), min_size=3, max_size=3), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(vectors_, vectors_)
def test_tournament_finds_the_nearest(centroids, points):
    tournament = bisectors.Tournament(centroids)
    x = np.array(points, np.int64)
    best = tournament.winners(x)
    far = ((x[:, None, :] - np.array(centroids)[None]) ** 2).sum(2)
    assert best.tolist() == far.argmin(1).tolist()
    assert tournament.distances(x, best).tolist() == far.min(1).tolist()


def test_largest_components_are_exact():
    top = bisectors.LARGEST
    centroids = [[top] * 64, [-top] * 64, [top - 1] * 64]
    x = np.array([[-top] * 64, [top - 1] * 64, [0] * 64], np.int64)
    tournament = bisectors.Tournament(centroids)
    best = tournament.winners(x)
    exact = [min((sum((int(a) - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for v in x]
    assert list(zip(tournament.distances(x, best).tolist(), best.tolist())) == exact
