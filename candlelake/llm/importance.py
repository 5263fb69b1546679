"""Importance resampling towards a target table: hashed n-gram gains, Gumbel noise, and ranks by regular sampling.

Weights come from arrays: a document is an array of bucket numbers, the gains of the buckets are one array of ``BUCKETS`` numbers, and
a weight is the floored mean of the gains looked up. Ranks come from parallel sorting by regular sampling: every task sorts its run
and takes each so-manieth row of it, these samples cut the order into segments, rows move to their segments and are merged there,
and the sizes of the segments before, added to a row's place in its own, are its exact rank. Segments that begin
after the last rank that is drawn are neither moved nor sorted.
"""

from __future__ import annotations

import math
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.stages import drop, map_arrow, parts, stage

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10
# samples in all from which the splitters are taken, and the most segments
SAMPLES, SEGMENTS = 1 << 16, 512
# words kept per Python worker with their buckets; bytes of a text that are cut into words at a time
_MEMO, _PIECE = 700_000, 1 << 22
_LAST = 2**63 - 1
# A-Z become a-z; letters, digits and bytes above 127 are word characters
_WORD = (string.ascii_letters + string.digits).encode() + bytes(range(128, 256))
_TABLE = bytes((chr(b).lower().encode()[0] if b < 128 else b) if b in _WORD else 32 for b in range(256))


class Buckets(dict):
    """Bucket of a feature: its CRC-32 modulo the number of buckets, kept for features seen before."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        found = zlib.crc32(feature) % self.n
        if len(self) < _MEMO:
            self[feature] = found
        return found

    def of(self, text: bytes, longest: int) -> tuple[np.ndarray, int]:
        """Buckets of all runs of 1 to ``longest`` words, and the number of words."""
        plain, found, words, low, held = text.translate(_TABLE), [], 0, 0, []
        while low < len(plain):
            high = plain.find(b" ", low + _PIECE)
            high = len(plain) if high < 0 else high
            piece = plain[low:high].split()
            low = high
            words += len(piece)
            found.append(np.fromiter(map(self.__getitem__, piece), np.uint32, len(piece)))
            joined = held + piece
            for run in range(2, longest + 1):
                # runs that end in this piece
                first = max(0, len(held) - run + 1)
                ends = range(first, len(joined) - run + 1)
                found.append(np.fromiter((self[b" ".join(joined[i : i + run])] for i in ends), np.uint32, len(ends)))
            held = joined[len(joined) - longest + 1 :] if longest > 1 else []
        return (np.concatenate(found) if found else np.zeros(0, np.uint32)), words


def _hashed(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """``texts`` with its column ``text`` replaced by ``found`` (bucket numbers, 32 bits each) and ``n_words``."""
    keys = [c for c in texts.columns if c != "text"]
    schema = ", ".join([*(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keys), "found binary", "n_words long"])

    def run(batches):
        memo = Buckets(buckets)
        for batch in batches:
            rows = [memo.of(t.as_py().encode() if t.is_valid else b"", longest) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keys), pa.array([f.astype("<u4").tobytes() for f, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
                names=[*keys, "found", "n_words"],
            )

    return texts.select(*keys, "text").mapInArrow(run, schema)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a batch, and the n + 1 offsets of its rows."""
    sizes = np.array([len(x.as_buffer()) // 4 for x in column], np.int64)
    raw = b"".join([x.as_buffer() for x in column])
    return np.frombuffer(raw, "<u4"), np.concatenate([[0], np.cumsum(sizes)])


def _totals(hashed: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: at most one row per task and bucket is shuffled, and a number per bucket reaches the driver."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch["found"])[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for r in hashed.select("found").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares per bucket, floored."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: ((t + 1) * float(s_all + n)) / ((s + 1) * float(t_all + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighed(hashed: DataFrame, gain: np.ndarray) -> DataFrame:
    """``did, at, n_words, n_features, weight``."""
    send = hashed.sparkSession.sparkContext.broadcast(gain)

    def weigh(batch):
        found, offsets = _numbers(batch["found"])
        sums = np.concatenate([[0], np.cumsum(send.value[found])])
        sizes = np.diff(offsets)
        weight = (sums[offsets[1:]] - sums[offsets[:-1]]) // np.maximum(sizes, 1)
        yield pa.RecordBatch.from_arrays(
            [batch["did"], batch["at"], batch["n_words"], pa.array(sizes), pa.array(weight)],
            names=["did", "at", "n_words", "n_features", "weight"],
        )

    return map_arrow(hashed.select("did", "at", "n_words", "found"), weigh, "did long, at long, n_words long, n_features long, weight long")


def _noise(seed: int):
    """``floor(-1000 ln(-ln u))`` of a uniform number drawn by the digest of the id; a null id has no digits."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("did").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """Rows as ``-score, id, at``, ascending in the order of the draw; null ids come last."""
    ids = batch["did"].fill_null(_LAST)
    return np.column_stack([-np.asarray(batch["score"]), np.asarray(ids), np.asarray(batch["at"])])


def _splitters(rows: DataFrame, n: int) -> np.ndarray:
    """Rows that cut the order into segments of about equal size, from samples that every sorted run gives at the same spacing."""
    spacing = max(1, n // SAMPLES)

    def regular(batches):
        seen = 0
        for batch in batches:
            places = np.arange(-seen % spacing, batch.num_rows, spacing)
            seen += batch.num_rows
            yield batch.take(pa.array(places))

    runs = rows.select("score", "did", "at").sortWithinPartitions(F.desc("score"), F.asc_nulls_last("did"), "at")
    samples = runs.mapInArrow(regular, "score long, did long, at long").toArrow()
    if not samples.num_rows:
        return np.zeros((0, 3), np.int64)
    keys = np.concatenate([_keys(b) for b in samples.to_batches()])
    keys = keys[np.lexsort(keys.T[::-1])]
    segments = min(SEGMENTS, parts(rows.sparkSession))
    return keys[[len(keys) * i // segments for i in range(1, segments)]]


def _before(splitters: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How many splitters are at or before each row."""
    low = np.searchsorted(splitters[:, 0], keys[:, 0], side="left")
    high = np.searchsorted(splitters[:, 0], keys[:, 0], side="right")
    segment = low.copy()
    tied = np.flatnonzero(low < high)
    while len(tied):  # splitters of the same score, one after the other
        at = splitters[segment[tied]]
        own = keys[tied]
        passed = (at[:, 1] < own[:, 1]) | ((at[:, 1] == own[:, 1]) & (at[:, 2] <= own[:, 2]))
        tied = tied[passed]
        segment[tied] += 1
        tied = tied[segment[tied] < high[tied]]
    return segment


def draw(rows: DataFrame, wanted: int, n: int) -> DataFrame:
    """``rows`` (with ``score, did, at``; ``at`` tells all ``n`` rows apart) with ``rank`` 1 to ``wanted`` by falling score, then id; null for the rest."""
    spark = rows.sparkSession
    send = spark.sparkContext.broadcast(_splitters(rows, n))

    def assign(batch):
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(_before(send.value, _keys(batch)).astype(np.int32))], names=[*batch.schema.names, "segment"]
        )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    assigned = map_arrow(rows, assign, f"{schema}, segment int")
    # a number per segment
    sizes = {r["segment"]: r["count"] for r in assigned.groupBy("segment").count().collect()}
    first, before = [], 0
    for segment in range(len(send.value) + 1):
        first.append(before)
        before += sizes.get(segment, 0)
    reached = sum(1 for place in first if place < wanted)
    merged = Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("did"), "at")
    place = F.get(F.array(*map(F.lit, first)), F.col("segment")).cast("long") + F.row_number().over(merged)
    ranked = assigned.where(F.col("segment") < reached).withColumn("rank", place)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    beyond = assigned.where(F.col("segment") >= reached).withColumn("rank", F.lit(None).cast("long"))
    return ranked.union(beyond).drop("segment")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs`` (with ``doc_id, text``).

    Features are the runs of 1 to ``longest`` words of the whole text, counted as often as they occur, also in ``target`` (with ``text``). Of the
    rows with at least ``least_words`` words the ``percent`` % of the highest scores, rounded down, are drawn and ranked from 1; ties go to the smaller id (null
    ids last), then to the row that Spark reads first. Null and empty texts have no features and weigh 0; with an empty
    target all weights still are defined. Rows that repeat an id have the same noise and each a rank of their own. Other columns
    play no part. An empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("did"), F.monotonically_increasing_id().alias("at"), F.col("text").cast("string").alias("text"))
    hashed = stage(_hashed(base, buckets, longest), "buckets")
    wanted = _hashed(target.select(F.col("text").cast("string").alias("text")), buckets, longest)
    gain = gains(_totals(hashed, buckets), _totals(wanted, buckets))
    scored = stage(_weighed(hashed, gain).withColumn("score", F.col("weight") + _noise(seed)), "scored")
    drop(hashed)
    enough = scored.where(F.col("n_words") >= least_words)
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    n = enough.count()
    return draw(enough, percent * n // 100, n).union(short).select(F.col("did").alias("doc_id"), "n_features", "weight", "score", "rank")


def keep_drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns. Rows without an id go; rows that share a drawn id all stay."""
    drawn = resample(docs, target, **options).where("rank is not null and doc_id is not null").select("doc_id").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, F.col("doc_id").cast("long").alias("did")).join(drawn.toDF("did"), "did", "left_semi").select("row.*")


def oracle() -> str:
    capital, small = string.ascii_uppercase, string.ascii_lowercase
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{capital}', '{small}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    digit = "instr('0123456789ABCDEF', substr(hexed, {}, 1)) - 1"
    byte = f"16 * ({digit.format('2 * i + 1')}) + {digit.format('2 * i + 2')}"
    return f"""
        WITH crc_table AS (  -- the CRC-32 of one byte, by its polynomial
            SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS entries
            FROM range(256) bytes(b)
        ),
        found AS MATERIALIZED (
            SELECT 0 AS target, doc_id, unnest({words}) AS word FROM documents
            UNION ALL SELECT 1, NULL, unnest({words}) FROM benchmark
        ),
        hexes AS (SELECT word, hex(encode(word)) AS hexed FROM found GROUP BY word),
        buckets AS MATERIALIZED (
            SELECT word, xor(list_reduce(
                [{byte} FOR i IN range(len(hexed) // 2)],
                lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} AS bucket
            FROM hexes, crc_table
        ),
        counts AS (
            SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM found JOIN buckets USING (word) GROUP BY bucket
        ),
        totals AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM counts),
        gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + {BUCKETS})) / ((s + 1) * (all_t + {BUCKETS})))) AS gain FROM counts, totals
        ),
        weights AS (
            SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight
            FROM found JOIN buckets USING (word) JOIN gains USING (bucket) WHERE target = 0 GROUP BY doc_id
        ),
        scores AS (
            SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || d.doc_id)[:8])::UBIGINT + 0.5::DOUBLE) / 4294967296))) AS score
            FROM documents d LEFT JOIN weights USING (doc_id)
        ),
        ranks AS (
            SELECT *, count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () AS n,
                row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place
            FROM scores
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
            CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * n // 100 THEN place::BIGINT END AS rank
        FROM ranks
    """
