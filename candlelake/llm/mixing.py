"""Mixing documents so that domains get target shares of the tokens, by soft membership.

A naive-Bayes classifier over distinct words and signs, learned from a labelled table, gives every document a
probability for each domain. A word's weight compares its share among all distinct words that documents of a domain show, so a long
text, which shows more of everything, is no likelier in any domain for its length. What a missing word says
does not depend on the length either. Projected-gradient least squares then finds nonnegative
rates: with ``t`` tokens and posteriors ``p`` of a document, the sums of ``rate * t * p`` over all documents
shall equal the targets. Gradients are measured per token (a document's weight is ``t``) and scaled by the
inverse Gram matrix of the domains over the documents with a rate, and a step is
``rate = max(0, rate + p . multipliers)``: the driver holds one multiplier per domain and step,
never a document. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.stages import stage

DOMAINS = ("good", "poor", "toxic")
# labelled documents used for the fit; documents that must show a word; weights that are broadcast (32 bytes each)
MOST_TRAINING = 20_000
LEAST_SUPPORT = 3
MOST_BROADCAST = 200_000
# weights are whole numbers of this size, so that sums don't depend on their order
_UNIT = 1e-9
_TEMPERATURES = [round(float(x), 3) for x in np.geomspace(0.5, 30, 24)]
MOST_STEPS, TOLERANCE = 60, 1e-6
# words, or runs of other signs
TOKENS = r"[\p{L}\p{M}]+|[^\p{L}\p{M}\s]+"


def domain_of_labels() -> Column:
    return (
        F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 0, F.lit(1)).when(F.col("quality") == 1, F.lit(0))
    )


def _tokens(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKENS), F.lit(0))


def _features(tokens: Column) -> Column:
    return F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t)))


@dataclass(frozen=True)
class Classifier:
    prior: np.ndarray  # log-odds of a text without any known word
    weights: DataFrame  # word (its hash) and the weight of every domain, w0, w1, ...
    broadcast: bool  # whether the weights are few enough
    temperature: float = 1.0

    def scores(self, rows: DataFrame, features: str) -> DataFrame:
        """``rows`` with an array ``_scores`` in place of ``features``: log-odds of every domain before the temperature."""
        others = [F.col(f"`{c}`") for c in rows.columns if c != features]
        # numbered below the explode, not in one select with it, which would number its rows
        numbered = rows.withColumn("_row", F.monotonically_increasing_id())
        words = numbered.select("_row", *others, F.explode_outer(features).alias("_word"))
        weights = F.broadcast(self.weights) if self.broadcast else self.weights
        joined = words.join(weights.withColumnRenamed("word", "_word"), "_word", "left")
        sums = joined.groupBy("_row", *others).agg(*(F.sum(f"w{d}").alias(f"_s{d}") for d in range(len(DOMAINS))))
        scores = [F.coalesce(f"_s{d}", F.lit(0)) * _UNIT + float(self.prior[d]) for d in range(len(DOMAINS))]
        return sums.select(*others, F.array(*scores).alias("_scores"))


def _softmax(scores: list[Column], temperature: float) -> list[Column]:
    top = F.greatest(*scores)
    parts = [F.exp((s - top) / temperature) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn domains from at most ``MOST_TRAINING`` labelled rows of ``docs``, chosen by a hash of their id.

    Of repeated labels of an id the worst counts; labels that are null teach nothing, nor do null texts.
    """
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marks = marks.select("doc_id", domain_of_labels().alias("domain")).where("doc_id is not null and domain is not null")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_TRAINING)
    # at most MOST_TRAINING ids and numbers
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = stage(texts.select("domain", _features(_tokens("text")).alias("features")), "mixing-sample")
    sizes, shown = np.zeros(len(DOMAINS)), np.zeros(len(DOMAINS))
    for r in rows.groupBy("domain").agg(F.count("*").alias("n"), F.sum(F.size("features")).alias("shown")).collect():
        sizes[r["domain"]], shown[r["domain"]] = r["n"], r["shown"]
    prior = np.log((sizes + 1) / (sizes + 1).sum())
    known = stage(_weights(rows, sizes, shown), "mixing-weights", small=True)
    total = known.agg(F.count("*"), *(F.coalesce(F.sum(f"absent{d}"), F.lit(0)) for d in range(len(DOMAINS)))).first()
    prior += np.array(total[1:], float) * _UNIT
    weights = known.select("word", *(f"w{d}" for d in range(len(DOMAINS))))
    fitted = Classifier(prior, weights, total[0] <= MOST_BROADCAST)
    scored = fitted.scores(rows, "features")
    losses = []
    for t in _TEMPERATURES:
        p = _softmax([F.get("_scores", F.lit(d)) for d in range(len(DOMAINS))], t)
        losses.append(F.avg(-F.log(F.get(F.array(*p), F.col("domain")) + 1e-9)).alias(f"t{len(losses)}"))
    found = scored.agg(*losses).first()
    best = min(range(len(losses)), key=lambda i: np.inf if found[i] is None else found[i])
    return Classifier(prior, weights, fitted.broadcast, _TEMPERATURES[best])


def _weights(rows: DataFrame, sizes: np.ndarray, shown: np.ndarray) -> DataFrame:
    """``word, absent0, absent1, ..., w0, w1, ...`` (what its absence says, and its presence beyond that) of the words whose shares differ between domains by more than chance.

    The measure is the likelihood ratio of the counts. Its bound lets about one word pass that says nothing.
    ``sizes``: documents by domain; ``shown``: their words.
    """
    domains = range(len(DOMAINS))
    counts = rows.select("domain", F.explode("features").alias("word")).groupBy("word")
    counts = counts.agg(F.count("*").alias("n"), *(F.count_if(F.col("domain") == d).alias(f"n{d}") for d in domains))
    counts = stage(counts, "mixing-words")
    share = shown / max(1.0, shown.sum())

    def surprise(d: int) -> Column:
        n = F.col(f"n{d}")
        return F.when(n > 0, n * F.log(n / (F.col("n") * float(share[d])))).otherwise(0.0)

    def weight(d: int) -> Column:
        if not shown[d]:
            return F.lit(0)
        own = (F.col(f"n{d}") + 0.5 * float(share[d])) / float(shown[d] + 0.5)
        overall = (F.col("n") + 0.5) / float(shown.sum() + 0.5)
        return F.round(F.log(own / overall) / _UNIT)

    def absent(d: int) -> Column:
        if not shown[d]:
            return F.lit(0)
        rate, overall = (F.col(f"n{d}") + 1) / float(sizes[d] + 2), (F.col("n") + 1) / float(sizes.sum() + 2)
        return F.round(F.log((1 - rate) / (1 - overall)) / _UNIT)

    telling = 2 * sum((surprise(d) for d in domains[1:]), surprise(0)) > 2 * float(np.log(max(1, counts.count())))
    known = counts.where((F.col("n") >= LEAST_SUPPORT) & telling)
    return known.select(
        "word",
        *(absent(d).cast("long").alias(f"absent{d}") for d in domains),
        *((weight(d) - absent(d)).cast("long").alias(f"w{d}") for d in domains),
    )


def with_posteriors(docs: DataFrame, classifier: Classifier, names: list[str]) -> DataFrame:
    """``docs`` with, in place of ``text``, their number of tokens and the posterior of every domain, called ``names``."""

    def describe(tokens):
        return F.struct(F.size(tokens).cast("long").alias("t"), _features(tokens).alias("f"))

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # arrays of one value bind a result to a name, so that it is computed once
    wide = docs.select(*others, F.inline(F.transform(F.array(_tokens("text")), describe)).alias(names[0], "_features"))
    scored = classifier.scores(wide, "_features")
    p = _softmax([F.get("_scores", F.lit(d)) for d in range(len(DOMAINS))], classifier.temperature)
    return scored.select(*others, names[0], *(x.alias(n) for x, n in zip(p, names[1:])))


def rate_of(multipliers: list[np.ndarray], posteriors: list[str]) -> Column:
    """The rate after steps with the given multipliers, from a rate of 1."""
    rate = F.lit(1.0)
    for step in multipliers:
        move = [F.col(p) * float(m) for p, m in zip(posteriors, step)]
        rate = F.greatest(F.lit(0.0), rate + sum(move[1:], move[0]))
    return rate


def fit_rates(scored: DataFrame, targets: dict[str, float], tokens: str, posteriors: list[str]) -> list[np.ndarray]:
    """Multipliers of the steps until the domain totals match, or the least-squares residual stops to fall.

    Each step is one aggregation of a few sums over ``scored``.
    """
    k = len(DOMAINS)
    weight = np.array([targets[d] for d in DOMAINS], float)
    if (weight < 0).any() or weight.sum() <= 0:
        raise ValueError("targets must be nonnegative and not all zero")
    size = scored.agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("n")).first()["n"]
    if not size:
        return []
    goal = weight / weight.sum() * float(size)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measure(steps):
        """Domain totals at the rates of ``steps``, and the Gram matrix of the documents with a rate."""
        mass = F.col("r") * F.col(tokens)
        live = F.when(F.col("r") > 0, F.col(tokens)).otherwise(0)
        sums = (
            scored.select(rate_of(steps, posteriors).alias("r"), tokens, *posteriors)
            .agg(
                *(F.sum(mass * F.col(p)) for p in posteriors),
                *(F.sum(live * F.col(posteriors[i]) * F.col(posteriors[j])) for i, j in pairs),
            )
            .first()
        )
        gram = np.zeros((k, k))
        for (i, j), x in zip(pairs, sums[k:]):
            gram[i, j] = gram[j, i] = x
        return goal - np.array(sums[:k], float), np.linalg.pinv(gram, rcond=1e-9, hermitian=True)

    steps: list[np.ndarray] = []
    residual, inverse = measure(steps)
    scale = inverse
    length, misses = 1.0, 0
    # the scaling of the documents that still have a rate makes long steps; one that doesn't help is halved
    for _ in range(MOST_STEPS):
        if np.abs(residual).max() <= TOLERANCE * float(size) or misses > 6:
            break
        trial = [*steps, length * (inverse @ residual)]
        left, beyond = measure(trial)
        if left @ scale @ left < residual @ scale @ residual * (1 - 1e-9):
            steps, residual, inverse, length, misses = trial, left, beyond, 1.0, 0
        else:
            length, misses = length / 2, misses + 1
    return steps


def _copies() -> Column:
    """Whole copies whose expectation is the rate: the rest of the rate is a hashed draw by id."""
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mixing")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(F.col("rate") + draw).cast("long")


TOKEN_NAMES = ["tokens", *(f"p_{d}" for d in DOMAINS)]


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``doc_id, source, tokens, p_<domain>..., rate, copies`` for every row of ``docs``.

    Null or empty texts have no tokens, and the prior as posteriors. Without labels all domains are
    alike, and so are all rates. Repeated rows are rated one by one; ids that repeat draw alike. Targets that
    the documents can't reach are met as nearly as nonnegative rates allow. An empty table gives no rows.
    """
    base = docs.select("doc_id", "text", "source")
    scored = stage(with_posteriors(base, train(docs, labels), TOKEN_NAMES), "posteriors")
    steps = fit_rates(scored, targets, TOKEN_NAMES[0], TOKEN_NAMES[1:])
    return scored.withColumn("rate", rate_of(steps, TOKEN_NAMES[1:])).withColumn("copies", _copies())


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """Rows of ``docs`` repeated by their copies; rows with none are dropped.

    Null and empty texts have no tokens and the prior as posteriors. Texts of any length are scored whole. Rows that repeat id and text draw
    alike and are each repeated as often. Without labels all domains are alike. Columns stay as they are, whatever their names; an
    empty table gives no rows.
    """
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("did"), text.alias("th"))
    base = docs.select("doc_id", text.alias("th"), "text")
    scored = stage(with_posteriors(base, train(docs, labels), TOKEN_NAMES), "posteriors")
    steps = fit_rates(scored, targets, TOKEN_NAMES[0], TOKEN_NAMES[1:])
    rated = scored.withColumn("rate", rate_of(steps, TOKEN_NAMES[1:])).withColumn("copies", _copies())
    # rows of one id and text are alike in everything
    once = rated.where("copies > 0").groupBy("doc_id", "th").agg(F.max("copies").alias("copies"))
    joined = keyed.join(once, keyed["did"].eqNullSafe(once["doc_id"]) & (keyed["th"] == once["th"]))
    repeated = joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("row.*")
