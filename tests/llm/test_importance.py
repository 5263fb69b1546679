"""Resampling against a plain computation, and ranks by regular sampling against a sort."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from candlelake.llm import importance

SCHEMA = "doc_id long, text string, did int, at string, found int, score int, rank int"
LAST = 2**63 - 1


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2, 3, 4) for d, t in rows], SCHEMA).repartition(5)


def features(text, longest):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(f.encode()) for f in runs]


def brute(docs, target, buckets, longest, least, percent):
    s, t, rows = [0] * buckets, [0] * buckets, []
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                counts[f % buckets] += 1
    gain = [
        math.floor(1000 * math.log(((b + 1) * float(sum(s) + buckets)) / ((a + 1) * float(sum(t) + buckets)))) for a, b in zip(s, t)
    ]
    for d, text in docs:
        words, found = features(text, longest)
        weight = sum(gain[f % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(found), weight, score, len(words) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], LAST if r[0] is None else r[0]))
    wanted = order[: percent * len(order) // 100]
    return rows, [(r[0], r[3]) for r in wanted]


def compare(spark, docs, target, buckets=10_000, longest=1, least=20, percent=10):
    rows, drawn = brute(docs, target, buckets, longest, least, percent)
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame(spark, docs), table, percent, least, buckets, longest).collect()
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score) for r in got], key=str) == sorted([r[:4] for r in rows], key=str)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == drawn


def corpus(n=400, seed=3):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta", "gamma9", "délta", "日本", "x", "ZZ"] + [f"w{i}" for i in range(300)]
    rows = [(int(i), rng.choice([" ", "-", "\n", "\x85"]).join(rng.choice(words, rng.integers(0, 60)))) for i in rng.permutation(n)]
    rows += [(1000, None), (1001, ""), (1002, "!!! --"), (None, "a b " * 15), (None, None), (3, "again " * 30), (3, "again " * 30)]
    return rows + [(1003, "very long, text; " * 200_000)]


TARGET = ["alpha beta w1 w2 w3 " * 10, None, "", "日本 w7 " * 5]


def test_all_rows(spark):
    compare(spark, corpus(), TARGET, percent=30)


def test_longer_runs_and_few_buckets(spark, monkeypatch):
    monkeypatch.setattr(importance, "_PIECE", 64)  # texts are cut in pieces; runs cross them
    compare(spark, corpus(), TARGET, buckets=50, longest=3, least=5, percent=100)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(frame(spark, corpus(20)).limit(0), none).count() == 0
    compare(spark, corpus(60), [], percent=50)
    compare(spark, [(1, "one two"), (2, None)], TARGET)


def test_keep_drawn(spark):
    docs, target = frame(spark, corpus(200)), spark.createDataFrame([(t,) for t in TARGET], "text string")
    drawn = {r.doc_id for r in importance.resample(docs, target).where("rank is not null").collect()}
    kept = importance.keep_drawn(docs, target)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == drawn - {None}


@pytest.mark.parametrize("samples, wanted", [(1 << 16, 900), (64, 2500), (1, 40), (64, 0)])
def test_ranks_of_many_ties(spark, monkeypatch, samples, wanted):
    """A third of the rows share score and id; samples are far apart."""
    monkeypatch.setattr(importance, "SAMPLES", samples)
    rng = np.random.default_rng(8)
    rows = [(5, None if i % 7 == 0 else 77, i) if i % 3 == 0 else (int(rng.integers(-20, 20)), int(rng.integers(0, 50)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "score long, did long, at long").repartition(6)
    got = importance.draw(df, wanted, len(rows)).collect()
    order = sorted(rows, key=lambda r: (-r[0], LAST if r[1] is None else r[1], r[2]))
    want = {r[2]: i + 1 for i, r in enumerate(order[:wanted])}
    assert len(got) == len(rows) and {r["at"]: r["rank"] for r in got if r["rank"] is not None} == want


def test_segments_are_even(spark):
    rng = np.random.default_rng(9)
    rows = [(int(x), int(i), int(i)) for i, x in enumerate(rng.integers(0, 5, 4000))]
    df = spark.createDataFrame(rows, "score long, did long, at long").repartition(6)
    splitters = importance._splitters(df, len(rows))
    keys = np.array([(-s, d, a) for s, d, a in rows])
    sizes = np.bincount(importance._before(splitters, keys), minlength=len(splitters) + 1)
    assert len(sizes) == 8 and sizes.max() <= 2 * len(rows) / 8
