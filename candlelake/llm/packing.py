"""Packing documents into token sequences along a Hilbert curve.

Each document becomes a hashed vector of its word counts, projected to a few
dimensions by fixed signs. Documents are range-sorted by the Hilbert key of that
point, so that neighbours on the curve, which are alike, share sequences; the
ids of all documents in this order are cut every ``capacity`` ids. Only the last
sequence can need padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.hashing import mix, word_hashes, words_of
from candlelake.llm.stages import giving_back, map_arrow, parts, runs_of_rows, stage, starts_of_parts, text_bytes
from candlelake.llm.tokens import ids_of_batch

DIMENSIONS, BITS = 4, 12
# texts on which the stretches of the curve are balanced
SAMPLE = 1 << 16
# rows of whole texts that a worker gets at a time
ARROW_ROWS = 2000


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    The usual transposed form of the curve: undo the reflections and exchanges of
    each level from the top bit down, then Gray-decode across the coordinates.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def points_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Projected word counts of texts as integer points; texts without words lie in the middle.

    Every word adds the signs that its hash gives to it; a sum is divided by the
    root of the number of words, so its size doesn't depend on the length.
    """
    starts, doc = words_of(data, offsets)
    hashes = mix(word_hashes(data, offsets, starts))
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    out = np.empty((n, DIMENSIONS))
    for d in range(DIMENSIONS):
        signs = ((hashes >> np.uint64(d)) & np.uint64(1)).astype(np.float64) * 2 - 1
        out[:, d] = np.bincount(doc, weights=signs, minlength=n)
    out /= np.sqrt(np.maximum(counts, 1))[:, None]
    half = 1 << (BITS - 1)
    # eight standard deviations of unrelated words fill the range; frequent words reach further and are clipped
    return np.clip(out * (half / 8) + half, 0, 2 * half - 1).astype(np.int64)


def _splitters(docs: DataFrame, n: int) -> np.ndarray:
    """Curve keys that cut the curve into ``n`` stretches of about equal bytes, found on a sample of at most about ``SAMPLE`` texts.

    They decide which task takes what, and never the result.
    """
    rows = max(1, docs.count())
    sample = docs.sample(min(1.0, SAMPLE / rows), seed=7)
    sizes = curve_keys(sample).select("curve", "tie", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    found = stage(sizes, "curve-sample", arrow_rows=ARROW_ROWS).toArrow()
    if not found.num_rows:
        return np.zeros((0, 2), np.int64)
    keys = np.column_stack([np.asarray(found["curve"]), np.asarray(found["tie"])])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    # an empty text costs something too
    weight = np.cumsum(np.asarray(found["size"], np.int64)[order] + 64)
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, n) / n)
    return np.unique(keys[order][cuts], axis=0)


def _stretch(splitters: np.ndarray, curve: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """How many splitters are at or before each row."""
    if not len(splitters):
        return np.zeros(len(curve), np.int64)
    low = np.searchsorted(splitters[:, 0], curve, side="left")
    high = np.searchsorted(splitters[:, 0], curve, side="right")
    for i in np.flatnonzero(low < high):  # several texts may share a key of the curve
        low[i] += np.searchsorted(splitters[low[i] : high[i], 1], tie[i], side="right")
    return low


def curve_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, text, tie`` with ``curve``, the Hilbert key of the text (null: empty); ``tie`` tells rows of one key apart."""

    def keys(batch):
        text = batch["text"]
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(text).fill_null(0), np.int64))])
        out = [
            hilbert_keys(points_of(*text_bytes(text.slice(a, b - a).fill_null("")))) for a, b in runs_of_rows(ends)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], text, batch["tie"], pa.array(np.concatenate(out))], names=["doc_id", "text", "tie", "curve"]
        )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tied = named.withColumn("tie", F.xxhash64("text", "doc_id"))
    return map_arrow(tied, keys, "doc_id long, text string, tie long, curve long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048) -> DataFrame:
    """Pieces of documents in sequences of ``capacity`` ids, one row per piece.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and
    ``ids``, the piece's ids as little-endian 32-bit bytes. A null or empty text is
    the end id alone. Rows with equal ids or texts are packed one by one, equal
    texts side by side. A text of any length is cut wherever a sequence ends. Other columns play no part; an empty table gives no rows.
    """

    def encode(batches):
        local = 0
        for batch in batches:
            for low, high, found, counts in ids_of_batch(vocabulary, batch["text"]):
                ends = np.cumsum(counts)
                starts = ends - counts
                # vocabularies of up to 65,536 ids are stored in two bytes
                narrow = found.max() < 1 << 16
                raw, size = (found.astype("<u2").tobytes(), 2) if narrow else (found.tobytes(), 4)
                ids = [raw[a * size : b * size] + (b"" if narrow else b"w") for a, b in zip(starts.tolist(), ends.tolist())]
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [rows["part"], rows["doc_id"], pa.array(starts + local), pa.array(counts), pa.array(ids, pa.binary())],
                    names=["part", "doc_id", "local", "doc_tokens", "ids"],
                )
                local += int(ends[-1])

    n = parts(docs.sparkSession)
    send = docs.sparkSession.sparkContext.broadcast(_splitters(docs, n))

    def assign(batch):
        stretch = _stretch(send.value, np.asarray(batch["curve"]), np.asarray(batch["tie"]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(stretch.astype(np.int32))], names=[*batch.schema.names, "stretch"])

    keyed = map_arrow(curve_keys(docs), assign, "doc_id long, text string, tie long, curve long, stretch int")
    ordered = keyed.repartitionById(n, "stretch").sortWithinPartitions("curve", "tie", "doc_id")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    coded = stage(
        ordered.mapInArrow(giving_back(encode), "part int, doc_id long, local long, doc_tokens long, ids binary"), "packing", arrow_rows=ARROW_ROWS
    )
    # a row per task: small at any size of the corpus
    placed = coded.join(F.broadcast(starts_of_parts(coded, "part", "doc_tokens")), "part")

    def cut(batch):
        rows = []
        for doc, at, coded in zip(
            batch["doc_id"].to_pylist(), batch["at"].to_pylist(), batch["ids"]
        ):
            raw = coded.as_py()
            ids = np.frombuffer(raw[:-1], "<u4") if len(raw) % 2 else np.frombuffer(raw, "<u2").astype("<u4")
            n, start = len(ids), 0
            while start < n:
                sequence, offset = divmod(at + start, capacity)
                length = min(n - start, capacity - offset)
                piece = ids[start : start + length].tobytes()
                rows.append((doc, start, length, zlib.crc32(piece), n, sequence, offset, piece))
                start += length
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 7 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    return map_arrow(
        placed.select("doc_id", (F.col("base") + F.col("local")).alias("at"), "ids"),
        cut,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
