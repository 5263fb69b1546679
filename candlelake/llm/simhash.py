"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint is cut into ``SEGMENTS`` parts. Two fingerprints that differ in at
most ``max_bits`` places differ in at most ``max_bits // SEGMENTS`` (here one) places of some
part. So each distinct fingerprint is filed once under every part, and each looks
into the buckets of a small Hamming ball around its own parts: of the values at
distance one only those with an added bit, since the other fingerprint of such a
pair looks the other way. What a bucket holds is compared in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.components import components
from candlelake.llm.stages import map_arrow, parts, stage

SEGMENTS = 3
# shingles whose bits are counted at a time
_CHUNK = 1 << 16
# comparisons of one bucket that are listed; larger buckets are compared in blocks
_SMALL = 4096


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """A bit is set if it is set in more than half of the hashes of the shingles, repeats counted.

    A-Z are lower-cased. Fewer words make one shingle of them all; no words, or a null, give 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[-n:].tolist()
    set_bits = np.zeros(64, np.int64)
    for low in range(0, n, _CHUNK):
        pairs = zip(starts[low : low + _CHUNK], ends[low : low + _CHUNK])
        hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        set_bits += bits.sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row as a signed 64-bit number."""

    def compute(batch):
        fps = [fingerprint(text.as_py(), words_per_shingle) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"]
        )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), compute, "doc_id long, fp long"
    )


def _segments() -> list[tuple[int, int]]:
    """First bit and width of each part of a 64-bit fingerprint."""
    edges = [64 * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucket_rows(fps: DataFrame) -> DataFrame:
    """``bucket, probe, fp``: where each fingerprint is filed (0) and where it looks (1)."""
    slots = []
    for number, (first, width) in enumerate(_segments()):
        value = F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)
        own = value.bitwiseOR(F.lit(number << 32))
        slots.append(own * 2)
        for bit in range(width):
            absent = F.col("fp").bitwiseAND(F.lit(_signed(1 << (first + bit)))) == 0
            slots.append(F.when(absent, own.bitwiseOR(F.lit(1 << bit)) * 2 + 1))
    rows = fps.select("fp", F.explode(F.array_compact(F.array(*slots))).alias("slot"))
    return rows.select(F.shiftright("slot", 1).alias("bucket"), F.col("slot").bitwiseAND(1).cast("int").alias("probe"), "fp")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class _Forest:
    """Union-find that remembers the links which joined two trees."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def link(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.links.append((a, b))


def _link_block(filed: np.ndarray, looking: np.ndarray, max_bits: int, forest: _Forest) -> None:
    """Link the groups of one large bucket: labels spread over its comparisons until none changes.

    Memory is bounded by the block; only one link per fingerprint comes out.
    """
    everyone = np.unique(np.concatenate([filed, looking]))
    labels = np.arange(len(everyone))
    right = np.searchsorted(everyone, filed)
    left = np.searchsorted(everyone, looking)
    step = max(1, (1 << 22) // len(filed))
    changed = True
    while changed:
        before = labels.copy()
        for low in range(0, len(looking), step):
            rows = left[low : low + step]
            near = np.bitwise_count(looking[low : low + step, None] ^ filed[None, :]) <= max_bits
            np.minimum.at(labels, rows, np.where(near, labels[right], len(labels)).min(1))
            np.minimum.at(labels, right, np.where(near, labels[rows][:, None], len(labels)).min(0))
        labels = np.minimum(labels, labels[labels])
        changed = (labels != before).any()
    for i in np.flatnonzero(labels != np.arange(len(labels))):
        forest.link(int(everyone[i]), int(everyone[labels[i]]))


def _linked(buckets: np.ndarray, probes: np.ndarray, fps: np.ndarray, max_bits: int, forest: _Forest) -> None:
    """Link fingerprints of rows sorted by bucket, filed ones first."""
    heads = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    sizes = np.diff(np.append(heads, len(buckets)))
    filed = np.add.reduceat(1 - probes.astype(np.int64), heads)
    # a filed row is compared with every later row of its bucket
    pairs = filed * sizes - filed * (filed + 1) // 2
    for i in np.flatnonzero(pairs > _SMALL):
        rows = fps[heads[i] : heads[i] + sizes[i]]
        _link_block(rows[: filed[i]], rows, max_bits, forest)
    small = np.flatnonzero((pairs > 0) & (pairs <= _SMALL))
    first = np.repeat(heads[small], filed[small]) + _counting(filed[small])
    later = np.repeat(heads[small] + sizes[small], filed[small]) - first - 1
    for low, high in _spans(later, 1 << 20):
        a = np.repeat(first[low:high], later[low:high])
        b = a + 1 + _counting(later[low:high])
        near = (np.bitwise_count(fps[a] ^ fps[b]) <= max_bits) & (fps[a] != fps[b])
        for x, y in zip(fps[a[near]].tolist(), fps[b[near]].tolist()):
            forest.link(x, y)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, end to end."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _spans(sizes: np.ndarray, limit: int):
    """Ranges of entries whose sizes sum to about ``limit`` at most."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(total, total[low] + limit, side="right")) - 1)
        yield low, high
        low = high


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all those within ``max_bits``.

    Each task links what its buckets hold and gives out a spanning forest of it, at most a link per
    fingerprint, never all pairs of a group.
    """
    if max_bits // SEGMENTS != 1:
        raise ValueError(f"balls of radius one serve {SEGMENTS} to {2 * SEGMENTS - 1} bits")

    def compare(batches):
        forest, held = _Forest(), []

        def run(rows):
            if len(rows[0]):
                _linked(*rows, max_bits, forest)

        for batch in batches:
            rows = [np.asarray(batch[c]) for c in ("bucket", "probe", "fp")]
            rows[2] = rows[2].view(np.uint64)
            held.append(rows)
            if rows[0][0] == rows[0][-1] and len(batch) > 1:
                continue  # the bucket may go on
            joined = [np.concatenate(c) for c in zip(*held)]
            end = np.searchsorted(joined[0], joined[0][-1])
            run([c[:end] for c in joined])
            held = [[c[end:] for c in joined]]
        if held:
            run([np.concatenate(c) for c in zip(*held)])
        ends = np.array(forest.links, np.uint64).reshape(-1, 2).view(np.int64)
        for low in range(0, len(ends), 1 << 16):
            part = ends[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])

    rows = bucket_rows(fps).repartition(parts(fps.sparkSession), "bucket").sortWithinPartitions("bucket", "probe")
    return rows.mapInArrow(compare, "a long, b long")


def near_groups(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits. Rows are connected if their fingerprints differ in at most
    ``max_bits`` bits; ``component_id`` is the least id that is reachable, the own one included (null if all
    of them are null). Equal fingerprints are one node, so copies make no pairs. Null and blank texts have
    fingerprint 0 and are linked like any other. An empty table gives no rows.
    """
    marked = stage(fingerprints(docs, words_per_shingle), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

