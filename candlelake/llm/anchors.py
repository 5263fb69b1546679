"""Candidate search for exact repeats of ``window`` units (words or bytes).

Every window of a document has an anchor: the least hash among its grams of
``gram`` units (all of them at ties). Equal windows have equal anchors at equal places, so a
window can only repeat where its anchor's gram does. About ``2 / (window - gram)`` of all
places are anchors; only they are shuffled, as hashes:

1. grams that occur once are gone after a count that combines before the shuffle;
2. anchors whose whole context (all windows over the gram) is equal are one class:
   its members need no more comparison, so copies by the thousand cost a count;
3. grams with several classes are contested. The contexts of one member of each
   class meet by gram, and an operator's own method decides which windows repeat.

A gram with more than ``MOST_CLASSES`` classes is not solved in one task: its windows are split by
their distance from the gram; each part shares a longer core, which is the new key. Cores that occur
once are gone after a count, as single grams are, and classes are formed anew, until groups are small. At
the last step window and core are one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm import hashing
from candlelake.llm.stages import drop, giving_back, join_groups, map_arrow, parts, runs_of_rows, stage, text_bytes

MOST_CLASSES = 1000
RANGES = 4
# units whose hashes are worked on at a time
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_HIGH = 32


@dataclass(frozen=True)
class Units:
    """How texts are cut: ``window`` and ``gram`` units of ``size`` bytes each in a stored context."""

    kind: str  # "bytes" or "words"
    window: int
    gram: int

    @property
    def size(self) -> int:
        return 1 if self.kind == "bytes" else 8

    @property
    def span(self) -> int:
        return self.window - self.gram

    def values(self, units: np.ndarray) -> np.ndarray:
        """64-bit value of every unit."""
        return hashing.BYTES[units] if self.kind == "bytes" else units

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of texts that lie end to end, and the bounds of each text's units."""
        if self.kind == "bytes":
            return data, offsets
        starts, doc = hashing.words_of(data, offsets)
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        pieces = []
        # hash runs of words; a cut falls on the start of a word
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + BLOCK)))
            begin, end = starts[low], starts[high] if high < len(starts) else len(data)
            inner = starts[low:high]
            pieces.append(hashing.word_hashes(data[begin:end], np.array([0, end - begin]), inner - begin))
            low = high
        return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64), bounds


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    """Powers of the base (0) or its inverse (1), modulo 2**64."""
    if n > len(_powers[which]):
        size = 1 << (n - 1).bit_length()
        factors = np.full(size, (_BASE, _INVERSE)[which], np.uint64)
        factors[0] = 1
        _powers[which] = np.cumprod(factors)
    return _powers[which][:n]


class Ranges:
    """Hashes of ranges of a sequence of values, from sums of values times powers."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power(0, len(values)), out=self.sums[1:])
        self.inverse = _power(1, len(values) + 1)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return hashing.mix((self.sums[high] - self.sums[low]) * self.inverse[low])


def anchors_of(values: np.ndarray, bounds: np.ndarray, units: Units) -> tuple[np.ndarray, ...]:
    """Places of all anchors, their texts, grams and context hashes; texts lie end to end."""
    window, gram, span = units.window, units.gram, units.span
    if len(values) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    ranges = Ranges(values)
    at = np.arange(len(values) - gram + 1)
    grams = ranges(at, at + gram)
    least = hashing.sliding(grams, span + 1, np.minimum)
    lengths = np.diff(bounds)
    ends = np.repeat(bounds[1:], lengths)
    # windows that leave their text don't count
    least[ends[: len(least)] - np.arange(len(least)) < window] = 0
    wall = np.zeros(span, np.uint64)
    over = hashing.sliding(np.concatenate([wall, least, wall]), span + 1, np.maximum)
    places = np.flatnonzero(over == grams)
    doc = np.searchsorted(bounds, places, side="right") - 1
    left = np.minimum(span, places - bounds[doc])
    low, high = places - left, np.minimum(places + window, bounds[doc + 1])
    context = hashing.mix(ranges(low, high) + hashing.mix((left << 20 | (high - low)).astype(np.uint64)))
    return places, doc, grams[places], context


def blocks_of(values_of: Callable[[int, int], np.ndarray], bounds: np.ndarray, units: Units) -> Iterator[tuple]:
    """Anchors of texts of any length: a long text is done in blocks that overlap by a window.

    Yields text numbers, places within the text, grams and contexts.
    """
    for low, high in runs_of_rows(bounds, BLOCK):
        begin, end = int(bounds[low]), int(bounds[high])
        if end - begin <= 2 * BLOCK:
            places, doc, grams, contexts = anchors_of(values_of(begin, end), bounds[low : high + 1] - begin, units)
            yield doc + low, places - (bounds[doc + low] - begin), grams, contexts
            continue
        for start in range(begin, end, BLOCK):
            a, b = max(begin, start - units.window), min(end, start + BLOCK + units.window)
            places, _, grams, contexts = anchors_of(values_of(a, b), np.array([0, b - a]), units)
            places = places + a
            mine = (places >= start) & (places < start + BLOCK)
            yield np.full(mine.sum(), low), places[mine] - begin, grams[mine], contexts[mine]


def anchor_rows(keyed: DataFrame, units: Units) -> DataFrame:
    """``gram, context, did, at`` for every anchor; ``at`` holds the place above the text's hash."""

    def rows(batch):
        data, offsets = text_bytes(batch["text"])
        did, th = np.asarray(batch["did"]), np.asarray(batch["th"]).astype(np.int64) & 0xFFFFFFFF
        for low, high in runs_of_rows(offsets):
            part = data[offsets[low] : offsets[high]]
            cut, bounds = units.cut(part, offsets[low : high + 1] - offsets[low])
            for doc, places, grams, contexts in blocks_of(lambda a, b: units.values(cut[a:b]), bounds, units):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)),
                        pa.array(contexts.view(np.int64)),
                        pa.array(did[doc + low]),
                        pa.array(places << _HIGH | th[doc + low]),
                    ],
                    names=["gram", "context", "did", "at"],
                )

    return map_arrow(keyed, rows, "gram long, context long, did long, at long")


def _place():
    return F.shiftright("at", _HIGH)


def _th():
    """The text's hash as an int, as in ``keyed_docs``."""
    low = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= F.lit(1 << 31), low - F.lit(1 << 32)).otherwise(low).cast("int").alias("th")


@dataclass(frozen=True)
class Repeats:
    """What the search knows: spans that are settled, and contexts that an operator has to compare.

    ``settled``: ``did, th, low, high`` in units, which may reach over the ends of the text.
    ``contested``: ``key, did, at, left, units`` with the context's units as bytes and the number of
    them before the anchor; all contexts of a key are needed together, and no key has many.
    """

    settled: list[DataFrame]
    contested: list[DataFrame]


def search(keyed: DataFrame, units: Units, keep_first: bool) -> Repeats:
    """Find the places where windows can repeat. ``keep_first``: the first member of a class isn't settled by it."""
    keyed = keyed.select("did", "th", "text")
    rows = stage(anchor_rows(keyed, units), "anchors")
    # joins read stored tables on both sides, so that Spark can split a gram with many rows
    repeated = stage(
        rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"),
        "repeated-grams",
        small=True,
    )
    # pieces of split partitions share tasks again: as many tasks as partitions, with equal numbers of pieces
    kept = stage(rows.join(repeated, "gram").coalesce(parts(keyed.sparkSession)), "repeated")
    drop(rows, repeated)
    settled, firsts = _classes(kept, "gram", ["context"], keep_first)
    spans = [_spans(settled, F.lit(units.span), F.lit(units.window))]
    places = (
        firsts.select("did", _th(), F.struct("gram", _place().alias("place")).alias("anchor"))
        .groupBy("did", "th")
        .agg(F.collect_list("anchor").alias("anchors"))
    )
    pending = stage(_contexts(keyed.join(places, ["did", "th"]), units), "contexts")
    contested = []
    while True:
        sizes = pending.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_CLASSES)
        large = stage(sizes.select("key"), "large-keys", small=True)
        if large.isEmpty():
            contested.append(pending)
            return Repeats(spans, contested)
        contested.append(pending.join(large, "key", "left_anti"))
        large_ones = pending.join(large, "key", "left_semi")
        pieces = stage(_ranges(large_ones, units), "ranges")
        # most cores occur once; the others alone are compared, and their units cut out
        cores = stage(
            pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated-cores", small=True
        )
        ranges = stage(pieces.join(cores, "key"), "repeated-ranges", small=True)
        drop(pieces, cores)
        settled, firsts = _classes(ranges, "key", ["context", "near", "far"], keep_first)
        spans.append(_spans(settled, F.col("far"), F.lit(units.window) - F.col("near")))
        pending = stage(_cut(large_ones, firsts, units), "contexts", small=True)


def _spans(settled: DataFrame, before, after) -> DataFrame:
    return settled.select(
        "did", _th(), (_place() - before).cast("int").alias("low"), (_place() + after).cast("int").alias("high")
    )


def _classes(rows: DataFrame, key: str, same: list[str], keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """Members of classes of two or more, and the first member of each class of a contested key."""
    classes = stage(
        rows.groupBy(key, *same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "at")).alias("first")),
        "classes",
        small=True,
    )
    settled = join_groups(rows, classes.where("n > 1"), [key, *same], "n", rows.count())
    if keep_first:
        settled = settled.where(F.struct("did", "at") != F.col("first"))
    contested = stage(classes.groupBy(key).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(key), "contested", small=True)
    firsts = classes.join(contested, key).select(key, *same, "first.did", "first.at")
    return settled, firsts


_CONTEXT = "key long, did long, at long, near int, far int, left int, units binary"


def _contexts(docs: DataFrame, units: Units) -> DataFrame:
    """One row per anchor of ``anchors``, with its context cut out of the text."""

    def rows(batch):
        size, window, span = units.size, units.window, units.span
        held, pieces, filled = [], [], 0

        def flush():
            did, at, grams, left = (np.concatenate(c) for c in zip(*held))
            k = len(did)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(grams),
                    pa.array(did),
                    pa.array(at),
                    pa.array(np.zeros(k, np.int32)),
                    pa.array(np.full(k, span, np.int32)),
                    pa.array(left.astype(np.int32)),
                    pa.array(pieces, pa.binary()),
                ],
                names=["key", "did", "at", "near", "far", "left", "units"],
            )

        ids, hashes = np.asarray(batch["did"]), np.asarray(batch["th"]).astype(np.int64) & 0xFFFFFFFF
        for i, (text, anchors) in enumerate(zip(batch["text"], batch["anchors"])):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            cut, _ = units.cut(raw, np.array([0, len(raw)]))
            raw, n = cut.tobytes(), len(cut)
            grams, places = (np.asarray(anchors.values.field(f)) for f in ("gram", "place"))
            left = np.minimum(span, places)
            ends = np.minimum(places + window, n) * size
            pieces += [raw[a:b] for a, b in zip(((places - left) * size).tolist(), ends.tolist())]
            held.append((np.full(len(places), ids[i]), places << _HIGH | hashes[i], grams, left))
            filled += len(places) * (window + span) * size
            if filled > 1 << 23:
                yield flush()
                held, pieces, filled = [], [], 0
        if held:
            yield flush()

    return map_arrow(docs.select("did", "th", "text", "anchors"), rows, _CONTEXT)


def _ranges(contexts: DataFrame, units: Units) -> DataFrame:
    """Each context in parts: its windows, which begin ``near`` to ``far`` units before the anchor, in equal ranges.

    ``key`` is the hash of the core that the windows of a range share, ``context`` that of all their units.
    """
    size, window = units.size, units.window

    def rows(batch):
        data, offsets = text_bytes(batch["units"])
        did, at = np.asarray(batch["did"]), np.asarray(batch["at"])
        columns = [np.asarray(batch[c]).astype(np.int64) for c in ("left", "near", "far")]
        for first, last in runs_of_rows(offsets, BLOCK):
            bounds = (offsets[first : last + 1] - offsets[first]) // size
            begin, n = bounds[:-1], np.diff(bounds)
            part = data[offsets[first] : offsets[last]]
            ranges = Ranges(units.values(part if size == 1 else part.view(np.uint64)))
            left, least, most = (c[first:last] for c in columns)
            step = -(-(most + 1 - least) // RANGES)
            for number in range(RANGES):
                near = least + number * step
                far = np.minimum(near + step - 1, most)
                # a text may have no such window
                has = np.flatnonzero((near <= most) & (near <= left) & (left - far + window <= n))
                if not len(has):
                    continue
                b, l, x, y = begin[has], left[has], near[has], far[has]
                low, high = np.maximum(0, l - y), np.minimum(n[has], l - x + window)
                key = hashing.mix(ranges(b + l - x, b + l - y + window) + (x << 20 | y).astype(np.uint64))
                context = hashing.mix(ranges(b + low, b + high) + (l - low).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(did[first:last][has]),
                        pa.array(at[first:last][has]),
                        pa.array(x.astype(np.int32)),
                        pa.array(y.astype(np.int32)),
                        pa.array(context.view(np.int64)),
                    ],
                    names=["key", "did", "at", "near", "far", "context"],
                )

    schema = "key long, did long, at long, near int, far int, context long"
    return map_arrow(contexts.select("did", "at", "near", "far", "left", "units"), rows, schema)


def _cut(contexts: DataFrame, firsts: DataFrame, units: Units) -> DataFrame:
    """The parts ``firsts`` of ``contexts``, with their units."""
    whole = contexts.select("did", "at", "left", "units", F.col("near").alias("least"), F.col("far").alias("most"))
    found = whole.join(firsts, ["did", "at"]).where("near >= least and far <= most").dropDuplicates(["key", "context"])
    low = F.greatest(F.lit(0), F.col("left") - F.col("far"))
    length = F.col("left") - F.col("near") + F.lit(units.window) - low
    # what reaches over the end of the units is cut there
    piece = F.substring("units", low * units.size + 1, length * units.size)
    return found.select("key", "did", "at", "near", "far", (F.col("left") - low).alias("left"), piece.alias("units"))


Solver = Callable[[list[tuple[int, int, int, int, bytes, int]]], Iterator[tuple[int, int, int, int]]]


def solve(repeats: Repeats, spark, solver: Solver, most: int) -> DataFrame:
    """``did, th, low, high``: settled spans and those that ``solver`` finds.

    The solver gets the contexts of whole keys, in ascending ``(did, place)`` order, as
    ``(key, did, place, left, units, th)``; several small keys come together, up to ``most`` contexts. It yields
    ``(number of the context, low, high)`` spans in units of the text.
    """

    def run(batches):
        held, key = [], None
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("key", "did", "at", "left", "units"))):
                if row[0] != key:
                    if len(held) >= most:
                        yield found(held)
                        held = []
                    key = row[0]
                held.append(row)
        if held:
            yield found(held)

    def found(rows):
        spans = list(solver([(k, did, at >> _HIGH, left, raw, at & 0xFFFFFFFF) for k, did, at, left, raw in rows]))
        which = np.array([s[0] for s in spans], np.int64)
        th = np.array([r[2] & 0xFFFFFFFF for r in rows], np.uint32).view(np.int32)
        did = np.array([r[1] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(did[which]),
                pa.array(th[which]),
                pa.array([s[1] for s in spans], pa.int32()),
                pa.array([s[2] for s in spans], pa.int32()),
            ],
            names=["did", "th", "low", "high"],
        )

    out = list(repeats.settled)
    for contexts in repeats.contested:
        rows = (
            contexts.select("key", "did", "at", "left", "units")
            .repartition(parts(spark), "key")
            .sortWithinPartitions("key", "did", "at")
        )
        out.append(rows.mapInArrow(giving_back(run), "did long, th int, low int, high int"))
    spans = out[0]
    for more in out[1:]:
        spans = spans.union(more)
    return spans


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``did, th``) and the ``spans`` of their text as arrays ``lows, highs``; none: null."""
    lists = spans.groupBy("did", "th").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return docs.join(lists, ["did", "th"], "left").withColumns(
        {"lows": F.col("spans.low"), "highs": F.col("spans.high")}
    ).drop("spans")


def covered(lows: np.ndarray, highs: np.ndarray, n: int, window: int) -> list[tuple[int, int]]:
    """Disjoint ascending spans of ``0..n`` that the given spans cover; touching spans are one.

    Spans are cut at the ends of the text; what is then shorter than a window holds none.
    """
    lows, highs = np.maximum(lows, 0), np.minimum(highs, n)
    long = highs - lows >= window
    if not long.any():
        return []
    order = np.argsort(lows[long], kind="stable")
    lows, reach = lows[long][order], np.maximum.accumulate(highs[long][order])
    heads = np.flatnonzero(np.concatenate([[True], lows[1:] > reach[:-1]]))
    return list(zip(lows[heads].tolist(), reach[np.append(heads[1:], len(lows)) - 1].tolist()))


def spans_of(batch: pa.RecordBatch):
    """``lows, highs`` of every row of a batch, as arrays; a null is no span."""
    lists = batch["lows"], batch["highs"]
    values = [np.asarray(c.values) for c in lists]
    offsets = np.asarray(lists[0].offsets), np.asarray(lists[1].offsets)
    for i in range(batch.num_rows):
        yield tuple(v[o[i] : o[i + 1]] for v, o in zip(values, offsets))
