"""Nearest vectors by inner product: inverted lists searched with an adaptive dimension scan.

Inner products become distances by one more coordinate: with ``M`` the greatest length, ``x`` gets
``sqrt(M^2 - |x|^2)`` and a query gets 0, so the nearest extended vector has the largest inner product. A random rotation then
spreads every difference evenly over the coordinates. They are stored in blocks of ``COLUMNS``, and
distances grow block by block: after ``d`` of ``D`` coordinates the partial distance, scaled by ``D / d``, estimates
the whole. A candidate whose estimate exceeds the distance to beat by more than chance allows (``EPSILON``
deviations) is abandoned. Survivors are scored exactly, on the original vectors.

Lists are the cells of k-means centres, fitted on a bounded sample; every vector is in one list. Their number grows with the root of the
table, so lists grow alike, and a query is sent once to each list that it probes. It first scans its nearest lists, as many as hold ``k``
candidates, which gives it a distance to beat, and then its other probed lists. How many are probed is measured: ``TRIALS`` queries are answered by
brute force, and so many lists are probed as hold ``RECALL`` of their true neighbours. Clustered vectors need few; vectors without any structure about
two thirds of 44 lists (2,000 rows) and half of 226 (51,000 rows). The tests abandon about one neighbour in forty besides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.stages import map_arrow, parts, stage

TRIALS, RECALL = 256, 0.95
# lists at most, and vectors that the centres are fitted on, per list: both bound what the driver holds
MOST_LISTS, SAMPLE_PER_LIST, ROUNDS = 4096, 32, 8
# rows of a block of a list; queries compared at a time
BLOCK_ROWS, QUERIES_AT_ONCE = 8192, 256
COLUMNS, EPSILON = 16, 2.1


def list_count(n: int) -> int:
    """The root of the number of vectors, within ``MOST_LISTS``."""
    return max(1, min(MOST_LISTS, math.isqrt(n)))


@dataclass(frozen=True)
class Space:
    size: int
    length: float  # greatest length of a vector
    rotation: np.ndarray
    centres: np.ndarray  # in the rotated space

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        rest = 0.0 if query else np.sqrt(np.maximum(self.length**2 - (vectors * vectors).sum(1), 0))
        extended = np.column_stack([vectors, np.broadcast_to(rest, len(vectors))])
        return extended @ self.rotation

    def lists(self, rotated: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of every vector, nearest first."""
        far = (self.centres * self.centres).sum(1) - 2 * (rotated @ self.centres.T)
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, variant, vec``: vectors that are neither null, zero nor empty and wholly finite; a stored table.

    Rows without an id take no part. Rows that repeat both id and vector are one; differing vectors of one id stay apart by ``variant``.
    Vectors of any length take part.
    """
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        table.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
        .where(finite & F.exists("vec", lambda x: x != 0))
        .withColumn("variant", F.xxhash64("vec"))
    )
    return stage(rows.groupBy("vec_id", "variant").agg(F.first("vec").alias("vec")), "vectors")


def fit(vectors: DataFrame, lists: int, seed: int = 42) -> Space | None:
    """Rotation and centres; centres come from at most ``lists * SAMPLE_PER_LIST`` vectors, chosen by a hash of the id."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    found = vectors.agg(F.max(norm).alias("length"), F.first(F.size("vec")).alias("size")).first()
    if found["size"] is None:
        return None
    rng = np.random.default_rng(seed)
    rotation, upper = np.linalg.qr(rng.standard_normal((found["size"] + 1,) * 2))
    rotation *= np.sign(np.diag(upper))
    bounded = vectors.orderBy(F.xxhash64("vec_id", "variant"), "vec_id", "variant").limit(lists * SAMPLE_PER_LIST)
    sample = np.array([r["vec"] for r in bounded.select("vec").collect()])
    space = Space(found["size"], found["length"], rotation, np.zeros((0, 0)))
    points = space.rotated(sample, query=False)
    k = max(1, min(lists, len(points) // 4))
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        cell = ((centres * centres).sum(1) - 2 * (points @ centres.T)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        count = np.bincount(cell, minlength=k)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return Space(found["size"], found["length"], rotation, centres)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    values = column.values if len(column) else pa.array([], pa.float64())
    return np.asarray(column.flatten() if len(column) else values, np.float64).reshape(-1, size)


def _survivors(near: list[np.ndarray], queries: np.ndarray, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that no test abandons. ``near``: the rows' columns in blocks; ``beat``: squared distances."""
    total = queries.shape[1]
    done = min(COLUMNS, total)
    first = near[0]
    q = queries[:, :done]
    partial = (q * q).sum(1)[:, None] + (first * first).sum(1)[None, :] - 2 * (q @ first.T)
    limit = beat * (1 + 1e-9) + 1e-9

    def bound(d: int) -> np.ndarray:
        return limit if d == total else limit * (d / total) * (1 + EPSILON / np.sqrt(d)) ** 2

    a, b = np.nonzero(partial <= bound(done)[:, None])
    partial = partial[a, b]
    for columns in near[1:]:
        if not len(a):
            break
        step = columns[b] - queries[a, done : done + columns.shape[1]]
        partial += np.einsum("ij,ij->i", step, step)
        done += columns.shape[1]
        alive = partial <= bound(done)[a]
        a, b, partial = a[alive], b[alive], partial[alive]
    return a, b


_FOUND = "query_id long, query_variant long, vec_id long, variant long, score double"


def _scan(index: DataFrame, probes: DataFrame, space: Space, k: int) -> DataFrame:
    """The best ``k`` of every probed block that are no farther than ``beat``; a query's own row is left out."""
    send = index.sparkSession.sparkContext.broadcast(space)
    size = space.size

    def best(keys, vectors, columns, query_keys, queries, beat):
        a, b = _survivors(columns, send.value.rotated(queries, query=True), beat)
        other = (query_keys[a] != keys[b]).any(1)
        a, b = a[other], b[other]
        scores = (queries[a] * vectors[b]).sum(1)
        order = np.lexsort((keys[b, 1], keys[b, 0], -scores, a))
        a, b, scores = a[order], b[order], scores[order]
        starts = np.searchsorted(a, np.arange(len(query_keys)))
        keep = np.arange(len(a)) - starts[a] < k
        return *query_keys[a[keep]].T, *keys[b[keep]].T, scores[keep]

    def run(batches):
        place = held = vectors = columns = None
        rows: list = []
        for batch in batches:
            places = np.column_stack([np.asarray(batch["list"]), np.asarray(batch["block"]), np.asarray(batch["query"])])
            cuts = np.flatnonzero((np.diff(places, axis=0) != 0).any(1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(places)]):
                key = tuple(places[low])
                part = batch.slice(low, high - low)
                own, found = np.column_stack([np.asarray(part["id"]), np.asarray(part["variant"])]), _matrix(part["vec"], size)
                if key[2] == 0:
                    if place != key[:2]:
                        place, rows = key[:2], []
                    rows.append((own, found))
                    columns = None
                    continue
                if place != key[:2]:
                    continue  # the block has no rows
                if columns is None:
                    held, vectors = (np.concatenate(c) for c in zip(*rows))
                    turned = send.value.rotated(vectors, query=False)
                    columns = [np.ascontiguousarray(turned[:, i : i + COLUMNS]) for i in range(0, turned.shape[1], COLUMNS)]
                beat = np.asarray(part["beat"])
                for i in range(0, len(own), QUERIES_AT_ONCE):
                    j = i + QUERIES_AT_ONCE
                    out = best(held, vectors, columns, own[i:j], found[i:j], beat[i:j])
                    if len(out[0]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in out], names=["query_id", "query_variant", "vec_id", "variant", "score"]
                        )

    both = index.select(
        "list", "block", F.lit(0).alias("query"), F.col("vec_id").alias("id"), "variant", F.lit(0.0).alias("beat"), "vec"
    ).union(probes.select("list", "block", F.lit(1), "query_id", "query_variant", "beat", "vec"))
    dealt = both.repartition(parts(index.sparkSession), "list", "block").sortWithinPartitions("list", "block", "query")
    return dealt.mapInArrow(run, _FOUND)


def _needed(filed: DataFrame, queries: DataFrame, space: Space, k: int, recall: float) -> int:
    """How many of its nearest lists a query has to probe, so that ``recall`` of the true neighbours of ``TRIALS`` queries are in them."""
    trial = queries.orderBy(F.xxhash64("vec_id", "variant"), "vec_id", "variant").limit(TRIALS).collect()
    if not trial:
        return 1
    asked = np.array([r["vec"] for r in trial])
    keys = np.array([(r["vec_id"], r["variant"]) for r in trial])
    send = filed.sparkSession.sparkContext.broadcast((asked, keys))

    def nearest(batches):
        asked, keys = send.value
        best, place = np.full((len(asked), 0), 0.0), np.zeros((len(asked), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = asked @ _matrix(batch["vec"], space.size).T
            own = np.column_stack([np.asarray(batch["vec_id"]), np.asarray(batch["variant"])])
            scores[(keys[:, None] == own[None]).all(2)] = -np.inf
            best = np.concatenate([best, scores], axis=1)
            place = np.concatenate([place, np.broadcast_to(np.asarray(batch["list"]), scores.shape)], axis=1)
            top = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, place = np.take_along_axis(best, top, 1), np.take_along_axis(place, top, 1)
        which, rank = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(best[which, rank]), pa.array(place[which, rank], pa.int32())], names=["query", "score", "list"]
        )

    found = filed.mapInArrow(nearest, "query int, score double, list int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "list")
    # TRIALS * k rows at most
    true = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "list").collect()
    places = np.argsort(space.lists(space.rotated(asked, query=True), len(space.centres)), axis=1)
    needed = np.sort([places[r["query"], r["list"]] for r in true])
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1 if len(needed) else 1


def _probes(sizes: np.ndarray, k: int, probed: int, space: Space):
    """For every query its lists, nearest first, as far as they are probed, and how many of them hold more than ``k`` vectors."""

    def choose(batch):
        order = space.lists(space.rotated(_matrix(batch["vec"], space.size), query=True), len(sizes))
        held = np.cumsum(sizes[order], axis=1)
        # all lists, if all of them do not hold so many
        first = np.minimum((held <= k).sum(1) + 1, len(sizes))
        chosen = [row[: max(probed, n)].astype(np.int32) for row, n in zip(order, first)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(chosen, pa.list_(pa.int32())), pa.array(first.astype(np.int32))],
            names=[*batch.schema.names, "lists", "first"],
        )

    return choose


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, lists: int | None = None, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score, query_variant, variant``: for each query the ``k`` vectors of largest inner product that were found.

    ``vectors`` and ``queries`` are as ``usable`` gives them, all of one length. A query's own row is no candidate; other rows of its id are.
    The nearest comes first, ties go to the smaller id. ``recall`` is the share of true neighbours that the probed lists shall hold. If the probed lists hold fewer than ``k`` candidates, the next nearest lists are
    probed too. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    n_lists = lists or list_count(vectors.count())
    space = fit(vectors, n_lists)
    if space is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_variant long, variant long")
    send = spark.sparkContext.broadcast(space)
    n_lists = len(space.centres)

    def assign(batch):
        found = send.value.lists(send.value.rotated(_matrix(batch["vec"], send.value.size), query=False), 1)[:, 0]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], names=[*batch.schema.names, "list"])

    filed = map_arrow(vectors.select("vec_id", "variant", "vec"), assign, "vec_id long, variant long, vec array<double>, list int")
    filed = stage(filed, "filed")
    # a row per list
    sizes = np.zeros(n_lists, np.int64)
    for r in filed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    probed = _needed(filed, queries, space, k, recall)
    blocks = F.array(*(F.lit(max(1, -(-int(n) // BLOCK_ROWS))) for n in sizes))
    block = F.pmod(F.xxhash64("vec_id", "variant"), F.get(blocks, F.col("list"))).cast("int")
    index = filed.withColumn("block", block)
    asked = stage(
        map_arrow(
            queries.select(F.col("vec_id").alias("query_id"), F.col("variant").alias("query_variant"), "vec"),
            lambda batch: _probes(sizes, k, probed, send.value)(batch),
            "query_id long, query_variant long, vec array<double>, lists array<int>, first int",
        ),
        "asked",
    )

    def probing(rows: DataFrame, chosen, beat) -> DataFrame:
        spread = rows.select("query_id", "query_variant", "vec", beat.alias("beat"), F.explode(chosen).alias("list"))
        every = F.sequence(F.lit(0), F.get(blocks, F.col("list")) - 1)
        return spread.withColumn("block", F.explode(every))

    infinite, query = F.lit(float("inf")), ["query_id", "query_variant"]
    first = stage(_scan(index, probing(asked, F.slice("lists", F.lit(1), F.col("first")), infinite), space, k), "first-lists")
    ranked = Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id", "variant")
    # the k-th score in the first lists gives the distance to beat
    worst = first.withColumn("r", F.row_number().over(ranked)).where(F.col("r") == k).select(*query, F.col("score").alias("worst"))
    own = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    known = asked.join(worst, query, "left").withColumn(
        "beat", F.coalesce(own + F.lit(space.length**2) - 2 * F.col("worst"), infinite)
    )
    others = F.slice("lists", F.col("first") + 1, F.size("lists"))
    rest = _scan(index, probing(known, others, F.col("beat")), space, k)
    return (
        first.union(rest)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "query_variant", "variant")
    )


def search_lengths(vectors: DataFrame, is_query, k: int = 20, recall: float = RECALL) -> DataFrame:
    """``search`` within the vectors of every length, for the rows where ``is_query`` holds: an inner product needs equal lengths."""
    sizes = [r["n"] for r in vectors.select(F.size("vec").alias("n")).distinct().orderBy("n").collect()]
    found = None
    for size in sizes or [0]:
        own = vectors.where(F.size("vec") == size)
        one = search(own, own.where(is_query), k, recall=recall)
        found = one if found is None else found.union(one)
    return found
