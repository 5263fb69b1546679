"""Domain posteriors and rates: accuracy, totals, optimality against a plain solver, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.llm import mixing

SCHEMA = "doc_id long, text string, source string, rate string, tokens int, p_good string"
TARGETS = {"good": 0.8, "poor": 0.15, "toxic": 0.05}


def table(spark, n=300):
    rng = np.random.default_rng(0)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzuvw"]
    rows, labels = [], []
    for i in range(n):
        kind = i % 3
        text = list(rng.choice(words, rng.integers(20, 80)))
        if kind == 1:
            text = [w + " %%%" for w in text]
        if kind == 2:
            text[3:3] = ["nasty"] * 2
        rows.append((i, " ".join(text), f"s{i % 2}", "x", 0, "y"))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 2)))
    rows += [(1000, None, None, "x", 0, ""), (1001, "", "s0", "", 0, ""), (1002, "nasty ax " * 40_000, "s0", "", 0, "")]
    rows += [(None, "ax bx", "s0", "", 0, ""), (5, "ax bx", "s0", "", 0, ""), (5, "ax bx", "s0", "", 0, "")]
    labels += [(1, 1, 0), (None, 1, 1), (7, None, None)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rates(spark):
    docs, labels = table(spark)
    rows = mixing.mixing_rates(docs, labels, TARGETS).collect()
    assert len(rows) == docs.count()
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    first = [i for i, r in enumerate(rows) if r.doc_id is not None and r.doc_id < 300 and r.tokens > 2]
    assert np.mean([p[i].argmax() == rows[i].doc_id % 3 for i in first]) > 0.95
    t = np.array([r.tokens for r in rows], float)
    rate = np.array([r.rate for r in rows])
    assert (rate >= 0).all()
    got = (rate * t) @ p
    goal = np.array([TARGETS[d] for d in mixing.DOMAINS]) * t.sum()
    # least squares over nonnegative rates can't be bettered: no rate has a way down
    slope = p @ (got - goal)
    assert np.allclose(got, goal, rtol=1e-3) or ((slope * (rate > 1e-9) < 1e-3 * t.sum()).all())
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert {r.doc_id: r.tokens for r in rows}[1000] == 0


def test_totals_are_met(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3] * 3, 500)
    rows = [(int(t), *map(float, q)) for t, q in zip(rng.integers(1, 900, 500), p)]
    scored = spark.createDataFrame(rows, "t long, a double, b double, c double")
    targets = {"good": 0.7, "poor": 0.05, "toxic": 0.25}
    steps = mixing.fit_rates(scored, targets, "t", ["a", "b", "c"])
    rate = np.array([r[0] for r in scored.select(mixing.rate_of(steps, ["a", "b", "c"])).collect()])
    t = np.array([r[0] for r in rows])
    assert np.allclose((rate * t) @ p / t.sum(), list(targets.values()), atol=1e-4)


def test_mix_repeats_rows(spark):
    docs, labels = table(spark)
    mixed = mixing.mix(docs, labels, TARGETS)
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixing.mixing_rates(docs, labels, TARGETS).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {d: c for d, c in copies.items() if c}


def test_plans_are_native(spark):
    docs, labels = table(spark, 30)
    plan = mixing.mix(docs, labels, TARGETS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_labels_and_empty(spark):
    docs, labels = table(spark, 30)
    rows = mixing.mixing_rates(docs, labels.limit(0), TARGETS).collect()
    assert len({round(r.rate, 9) for r in rows}) == 1
    assert mixing.mixing_rates(docs.limit(0), labels, TARGETS).count() == 0
    assert mixing.mix(docs.limit(0), labels, TARGETS).count() == 0
    with pytest.raises(ValueError, match="targets"):
        mixing.mixing_rates(docs, labels, {"good": -1, "poor": 1, "toxic": 1})


def test_held_out_posteriors(spark):
    """Learned from four of five labelled rows of the given tables, the posteriors hold for the fifth."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0
    classifier = mixing.train(docs, labels.where(~held))
    truth = labels.where(held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    truth = truth.select("doc_id", mixing.domain_of_labels().alias("domain")).where("domain is not null")
    names = ["tokens", "p0", "p1", "p2"]
    rows = mixing.with_posteriors(docs.select("doc_id", "text"), classifier, names).join(truth, "doc_id").collect()
    p, y = np.array([r[2:5] for r in rows]), np.array([r.domain for r in rows])
    t, told = np.array([r.tokens for r in rows]), np.array([r[2:5] for r in rows]).argmax(1)
    loss = -np.log(p[np.arange(len(y)), y] + 1e-9).mean()
    toxic = told == 2
    figures = f"accuracy {(told == y).mean():.3f}, log-loss {loss:.3f}, short toxic {toxic[(y == 2) & (t < 300)].mean():.3f}, "
    figures += f"long clean as toxic {toxic[(y == 0) & (t > 2000)].sum()} of {((y == 0) & (t > 2000)).sum()}"
    print(figures)
    assert (told == y).mean() > 0.85 > (y == 0).mean() and loss < 0.5, figures
    assert toxic[(y == 2) & (t < 300)].mean() > 0.7 and toxic[(y == 0) & (t > 2000)].mean() < 0.3, figures


def test_weights_that_are_too_many_are_joined_by_key(spark, monkeypatch):
    docs, labels = table(spark, 60)
    few = {tuple(r) for r in mixing.mixing_rates(docs, labels, TARGETS).collect()}
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    assert {tuple(r) for r in mixing.mixing_rates(docs, labels, TARGETS).collect()} == few
