"""Near copies by the Jaccard index of word shingles: SimHash finds candidates by Hamming balls, the shingles decide.

Two sets of Jaccard index ``J`` differ in a bit of a SimHash with a chance of ``acos(2J / (1 + J)) / pi`` at most, 0.15 at 0.8, so about
10 of 64 bits differ, which balls of a small radius can't reach. Here a fingerprint has 256 bits in ``SEGMENTS`` parts of
16. A text is filed under each part and looks into the ball of radius one around it. At 0.8 a part is within that radius with a chance of 0.28, so
99.5 % of such pairs meet, and more of likelier ones. A text of at most ``SHORT`` shingles is also filed under the least of them, as many as any
set of index 0.8 must share one of: those pairs are all found. What meets is compared by the first half of the bits, then by the complete
distance, then by the shingles of both texts, which are computed for candidates only.

Texts with several near ones in a bucket meet there again with ``PARITIES`` bits, which bound the index from above: what they exclude is below 0.8 for
certain, so the pairs of a crowd of unlike texts are never written. Of what they allow only the nearest are tested at once, and of further pairs those
that are not connected by then.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm import hashing
from candlelake.llm.components import components
from candlelake.llm.exact_copies import bit_filter, passing
from candlelake.llm.simhash import _counting, _spans
from candlelake.llm.stages import drop, giving_back, parts, stage

WORDS, LEAST_LIKENESS = 5, 0.8
SEGMENTS, WIDTH, SHORT = 16, 16, 40
# bits that may differ: of the first 128 by parts and by shingles, and of all 256
NEAR, NEAR_SHORT, NEAR_ALL = 36, 48, 66
# candidates of a row in a bucket that are tested at once
NEAREST = 1
# bits of the bound on the index
PARITIES = 2048
_CHUNK = 255 * 16
# comparisons at a time
_BLOCK = 1 << 18
_LONGS = SEGMENTS * WIDTH // 64
_ODD = hashing._stream(1 << 42, _LONGS) | np.uint64(1)
_FACTORS = hashing._stream(1 << 43, WORDS) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Ascending hashes of the distinct runs of ``WORDS`` words; A-Z are lower-cased.

    Fewer words make one shingle of them all; no words, or a null, make none.
    """
    raw = (text or "").encode().lower()
    data, ends = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    starts, _ = hashing.words_of(data, ends)
    words = hashing.word_hashes(data, ends, starts)
    if not len(words):
        return words
    n = max(1, len(words) - WORDS + 1)
    total = np.zeros(n, np.uint64)
    for j in range(min(WORDS, len(words))):
        total += words[j : j + n] * _FACTORS[j]
    return np.unique(hashing.mix(total))


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """256 bits, as 4 numbers: a bit is set if it is set in more than half of the hashes of the distinct shingles."""
    total = np.zeros(_LONGS * 64, np.int64)
    for low in range(0, len(found), _CHUNK):
        hashes = hashing.mix(found[low : low + _CHUNK, None] * _ODD[None, :])
        bits = np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little")
        for i in range(0, len(bits), 255):
            total += bits[i : i + 255].sum(0, dtype=np.uint8)
    return np.packbits(total * 2 > len(found), bitorder="little").view("<u8")


def parities(found: np.ndarray) -> bytes:
    """Whether an even or odd number of hashes has each value modulo ``PARITIES``. Two sets differ in as many shingles at least as in these bits."""
    counts = np.bincount((hashing.mix(found) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits(counts & 1).tobytes()


def _least(found: np.ndarray) -> np.ndarray:
    """The least shingles of a short text, of which any text of enough likeness shares one; marked by the sign."""
    if len(found) > SHORT:
        return np.zeros(0, np.int64)
    n = len(found) - math.ceil(LEAST_LIKENESS * len(found) - 1e-9) + 1
    return (found[:n] | np.uint64(1 << 63)).view(np.int64)


_FP = [f"f{i}" for i in range(_LONGS)]
_MARKED = "did long, th long, key long, " + ", ".join(f"{c} long" for c in _FP) + ", least array<long>, n int, parities binary"


def _marked(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``. ``key`` stands for the set of shingles; what follows is null where a task repeats a key, or for key 0."""

    def compute(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, rest = [], []
            for text in batch["text"]:
                found = shingles(text.as_py())
                key = _key(found)
                keys.append(key)
                if key in seen or not len(found):
                    rest.append((None,) * (_LONGS + 3))
                    continue
                seen.add(key)
                rest.append((*wide_fingerprint(found).view(np.int64).tolist(), _least(found), len(found), parities(found)))
            columns = list(zip(*rest)) if rest else [()] * (_LONGS + 3)
            kinds = [pa.int64()] * _LONGS + [pa.list_(pa.int64()), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch["did"], batch["th"], pa.array(keys, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["did", "th", "key", *_FP, "least", "n", "parities"],
            )

    return docs.select("did", "th", "text").mapInArrow(giving_back(compute), _MARKED)


def _key(found: np.ndarray) -> int:
    return int(hashing.mix(found).sum().view(np.int64)) if len(found) else 0


def bucket_rows(nodes: DataFrame, *more: str) -> DataFrame:
    """``bucket, probe, key, f0...`` and columns ``more``: where each text is filed (0) and where it looks (1).

    Of the ball of radius one it looks only at the values with an added bit: the other text of such a pair looks the other way.
    """
    slots = []
    for number in range(SEGMENTS):
        first = number * WIDTH % 64
        value = F.shiftrightunsigned(_FP[number * WIDTH // 64], first).bitwiseAND((1 << WIDTH) - 1)
        own = value.bitwiseOR(F.lit(number << WIDTH))
        slots.append(F.struct(own.alias("bucket"), F.lit(0).alias("probe")))
        for bit in range(WIDTH):
            absent = value.bitwiseAND(F.lit(1 << bit)) == 0
            slots.append(F.when(absent, F.struct(own.bitwiseOR(F.lit(1 << bit)).alias("bucket"), F.lit(1).alias("probe"))))
    least = F.transform("least", lambda x: F.struct(x.alias("bucket"), F.lit(0).alias("probe")))
    every = F.concat(F.array_compact(F.array(*slots)), least)
    rows = nodes.select(F.explode(every).alias("slot"), "key", *_FP, *more)
    return rows.select("slot.bucket", "slot.probe", "key", *_FP, *more)


def _chunks(batches, columns: list[str]):
    """Sorted rows as arrays of their columns, cut between buckets."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([np.asarray(batch[c]) for c in columns])
        if held[-1][0][0] == held[-1][0][-1] and len(held[-1][0]) > 1:
            continue  # the bucket may go on
        joined = [np.concatenate(c) for c in zip(*held)]
        end = int(np.searchsorted(joined[0], joined[0][-1]))
        if end:
            yield [c[:end] for c in joined]
        held = [[c[end:] for c in joined]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _are_near(a, b, buckets, bits) -> np.ndarray:
    """Which pairs of rows are near by their first bits, then by all, and meet here first."""
    f0, f1 = bits[:, 0], bits[:, 1]
    apart = np.bitwise_count(f0[a] ^ f0[b]).astype(np.int16) + np.bitwise_count(f1[a] ^ f1[b])
    near = np.flatnonzero(apart <= np.where(buckets[a] >= 0, NEAR, NEAR_SHORT))
    differing = bits[a[near]] ^ bits[b[near]]
    by_part = np.bitwise_count(differing.view(np.uint16))
    # few shingles make wild bits: pairs that share one of short texts need not be near by all
    is_part, all_near = buckets[a[near]] >= 0, by_part.sum(1, dtype=np.int16) <= NEAR_ALL
    meets = by_part <= 1
    first = np.where(meets.any(1), meets.argmax(1), SEGMENTS)
    half = apart[near] <= NEAR
    here = np.where(is_part, all_near & (first == buckets[a[near]] >> WIDTH), ~(half & all_near & (first < SEGMENTS)))
    return near[here]


def _places(row, other, keys, bits) -> np.ndarray:
    """The place of each pair among those of its row, in the order of their distance."""
    apart = np.bitwise_count(bits[row] ^ bits[other]).sum(1, dtype=np.int16)
    order = np.lexsort((keys[other], apart, row))
    heads = np.flatnonzero(np.diff(row[order], prepend=-1))
    places = np.empty(len(row), np.int64)
    places[order] = _counting(np.diff(np.append(heads, len(row))))
    return places


def _blocks(heads, sizes, filed):
    """Runs of filed rows of sorted buckets and how many rows each is compared with, ``_BLOCK`` comparisons at a time.

    A run is ``rows, first, counts``: each of ``rows`` is compared with the ``counts`` rows from ``first`` on.
    """
    compared = filed * sizes
    small = np.flatnonzero((compared > 0) & (sizes > 1) & (compared <= _BLOCK))
    for low, top in _spans(compared[small], _BLOCK):
        some = small[low:top]
        yield np.repeat(heads[some], sizes[some]) + _counting(sizes[some]), np.repeat(heads[some], sizes[some]), np.repeat(filed[some], sizes[some])
    for i in np.flatnonzero(compared > _BLOCK).tolist():
        step = max(1, (_BLOCK) // int(filed[i]))
        for start in range(0, int(sizes[i]), step):
            rows = heads[i] + np.arange(start, min(start + step, int(sizes[i])))
            yield rows, np.full(len(rows), heads[i]), np.full(len(rows), filed[i])


def _fits(a, b, n) -> np.ndarray:
    """Which pairs may have an index of ``LEAST_LIKENESS`` by their sizes."""
    return np.minimum(n[a], n[b]) >= LEAST_LIKENESS * np.maximum(n[a], n[b]) - 1e-9


def _may_be_alike(a, b, n, marks) -> np.ndarray:
    """Which pairs that fit may have an index of ``LEAST_LIKENESS`` by their parities."""
    both = n[a] + n[b]
    differing = np.bitwise_count(marks[a] ^ marks[b]).sum(1, dtype=np.int64)
    return both - differing >= LEAST_LIKENESS * (both + differing) - 1e-6


def _near_pairs(chunk, bits):
    """``row, other`` of the rows of a chunk that are near and fit, each pair once, some at a time."""
    buckets, probes, keys, n = (chunk[c] for c in ("bucket", "probe", "key", "n"))
    heads = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    sizes = np.diff(np.append(heads, len(buckets)))
    filed = np.add.reduceat(1 - probes.astype(np.int64), heads)
    for rows, first, counts in _blocks(heads, sizes, filed):
        row = np.repeat(rows, counts)
        other = np.repeat(first, counts) + _counting(counts)
        near = _are_near(row, other, buckets, bits)
        row, other = row[near], other[near]
        # two filed rows meet both ways
        once = ((keys[row] < keys[other]) | (probes[row] > 0) & (keys[row] != keys[other])) & _fits(row, other, n)
        yield row[once], other[once]


def _pairs_and_ends(chunk, x, y, ends) -> pa.RecordBatch:
    """``a, b, bucket, probe``: pairs of rows as ``a, b``, and rows ``ends`` as ``a`` with their bucket."""
    keys = chunk["key"]
    x, y = keys[x], keys[y]
    a, b = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0).T
    columns = [
        pa.array(np.concatenate([a, keys[ends]])),
        pa.concat_arrays([pa.array(b.copy()), pa.nulls(len(ends), pa.int64())]),
        pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(chunk["bucket"][ends])]),
        pa.concat_arrays([pa.nulls(len(a), pa.int32()), pa.array(chunk["probe"][ends].astype(np.int32))]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "bucket", "probe"])


def _look(columns: list[str]):
    """Pairs of rows that are near by their bits, and rows that have to meet again, by ``_pairs_and_ends``.

    A pair without other near rows in its bucket is a pair; all other near rows are ends. With ``parities``: every row and its ``NEAREST`` of those that may be alike
    enough are pairs, both rows of any further pair are ends. With ``root`` too: all pairs that may be alike and are not connected, and no ends.
    """
    rooted, bounded = "root" in columns, "parities" in columns

    def lone(chunk, bits):
        degree, partner = np.zeros(len(bits), np.int64), np.zeros(len(bits), np.int64)
        for row, other in _near_pairs(chunk, bits):
            np.add.at(degree, row, 1)
            np.add.at(degree, other, 1)
            partner[row] = other
            partner[other] = row
        single = np.flatnonzero(degree == 1)
        single = single[degree[partner[single]] == 1]
        degree[single] = 0
        return single, partner[single], np.flatnonzero(degree)

    def alike(chunk, bits):
        marks, n = np.frombuffer(b"".join(chunk["parities"]), np.uint64).reshape(len(bits), -1), chunk["n"]
        pairs, further = [np.zeros((2, 0), np.int64)], np.zeros(len(bits), bool)
        for row, other in _near_pairs(chunk, bits):
            may = _may_be_alike(row, other, n, marks)
            if rooted:
                may &= chunk["root"][row] != chunk["root"][other]
            row, other = row[may], other[may]
            if not rooted:
                # of two filed rows either has its nearest
                filed = chunk["probe"][row] == 0
                x, y = np.concatenate([row, other[filed]]), np.concatenate([other, row[filed]])
                nearest = _places(x, y, chunk["key"], bits) < NEAREST
                further[x[~nearest]] = further[y[~nearest]] = True
                row, other = x[nearest], y[nearest]
            pairs.append(np.stack([row, other]))
        return *np.concatenate(pairs, axis=1), np.flatnonzero(further)

    def run(batches):
        for chunk in _chunks(batches, columns):
            chunk = dict(zip(columns, chunk))
            chunk["n"] = chunk["n"].astype(np.int64)
            bits = np.stack([chunk[c] for c in _FP], axis=1).view(np.uint64)
            yield _pairs_and_ends(chunk, *(alike if bounded else lone)(chunk, bits))

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(parts(rows.sparkSession), "bucket").sortWithinPartitions("bucket", "probe", "key")


def _sets(keys: DataFrame, marked: DataFrame, docs: DataFrame) -> DataFrame:
    """``key, shingles`` of ``keys``, from one text of each; only these texts are read again and shuffled."""
    where = F.min(F.struct(F.coalesce("did", F.lit(0)).alias("d"), F.isnull("did").alias("unnamed"), "th")).alias("text")
    chosen = marked.join(keys, "key", "left_semi").groupBy("key").agg(where).select("key", "text.*")
    chosen = stage(chosen, "chosen-texts", small=True)
    named = docs.select(F.coalesce("did", F.lit(0)).alias("d"), F.isnull("did").alias("unnamed"), "th", "text")
    filter_ = stage(bit_filter(chosen, "d", "unnamed", "th"), "chosen-filter", small=True)
    texts = passing(named, filter_, "d", "unnamed", "th").where("passes").drop("passes")
    found = texts.join(chosen, ["d", "unnamed", "th"]).select("key", "text").dropDuplicates(["key"])

    def compute(batches):
        for batch in batches:
            lists = [shingles(t.as_py()).view(np.int64) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(lists, pa.list_(pa.int64()))], names=["key", "shingles"])

    sets = stage(found.mapInArrow(giving_back(compute), "key long, shingles array<long>"), "sets")
    drop(chosen, filter_)
    return sets


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those ``a, b`` whose sets have a Jaccard index of at least ``LEAST_LIKENESS``."""

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(x) + len(y)
                keep.append(
                    min(len(x), len(y)) >= LEAST_LIKENESS * max(len(x), len(y)) - 1e-9
                    and (c := len(np.intersect1d(x, y, assume_unique=True))) >= LEAST_LIKENESS * (both - c) - 1e-9
                )
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(giving_back(test), "a long, b long")


def _linked(pairs: DataFrame, marked: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b``: those of ``pairs`` that are verified; a stored table."""
    sets = _sets(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), marked, docs)
    links = stage(_verified(pairs, sets), "links", small=True)
    drop(sets)
    return links


def _merged(groups: DataFrame, links: DataFrame, rooted: DataFrame) -> DataFrame:
    """``groups`` after ``links`` between different ones, or nodes of none; ``rooted`` has ``key, root`` of every node. Only roots are linked anew."""
    x, y = rooted.select(F.col("key").alias("a"), F.col("root").alias("x")), rooted.select(F.col("key").alias("b"), F.col("root").alias("y"))
    between = links.join(x, "a").join(y, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    over = components(between)
    moved = groups.join(over.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    merged = stage(moved.union(over.join(groups, "node", "left_anti")), "merged", small=True)
    drop(groups, over)
    return merged


def _grouped(links: DataFrame) -> DataFrame:
    """``components`` of many links a node: first of the least neighbours, a link a node, then of what links those groups."""
    both = links.select("a", "b").union(links.select("b", "a")).toDF("a", "b")
    groups = components(both.groupBy("a").agg(F.min("b").alias("b")))
    return _merged(groups, links, groups.withColumnRenamed("node", "key"))


def _roots(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, root`` of every key that has a near copy of another key; a stored table.

    Pairs that are near by their bits are tested, but rows with more near ones in a bucket meet there again with their parities first, and only the
    nearest few that these allow are tested. Further pairs that are not connected by then are all tested, in the buckets where the ends of such pairs
    have different groups. So a large group costs a few links a row, and no candidate between two groups is left out.
    """
    nodes = stage(marked.where("f0 is not null").dropDuplicates(["key"]).drop("did", "th"), "nodes", small=True)
    comparing = ["bucket", "probe", "key", *_FP, "n", "parities"]

    def look(rows, name):
        found = stage(_dealt(rows).mapInArrow(giving_back(_look(rows.columns)), "a long, b long, bucket long, probe int"), name)
        return found, found.where("b is not null").select("a", "b"), found.where("b is null").select("bucket", "probe", F.col("a").alias("key"))

    near, lone, crowds = look(bucket_rows(nodes, "n"), "candidates")
    again, nearest, ends = look(crowds.join(nodes, "key").select(comparing), "crowds")
    tested = stage(lone.union(nearest).distinct(), "tested", small=True)
    links = _linked(tested, marked, docs)
    groups = _grouped(links)
    drop(near, tested, links)
    if not ends.isEmpty():
        rooted = nodes.join(groups.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root"))
        ends = stage(ends.join(rooted, "key"), "ends", small=True)
        mixed = ends.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("bucket")
        apart = ends.join(mixed, "bucket", "left_semi").join(nodes, "key")
        further, pairs, _ = look(apart.select(*comparing, "root"), "further")
        tested = stage(pairs.distinct(), "tested", small=True)
        if not tested.isEmpty():
            links = _linked(tested, marked, docs)
            groups = _merged(groups, links, rooted)
            drop(links)
        drop(ends, further, tested)
    drop(nodes, again)
    return groups


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, one of each group of near copies: that of the least id (null ids last), then of the least text hash.

    Rows are connected if their sets of ``WORDS``-word shingles have a Jaccard index of ``LEAST_LIKENESS`` or more. Null and empty texts and
    texts without words are one group. Rows that share an id but not the text are apart. Of rows that share both, one stays. Texts of any
    length are read whole; an empty table gives no rows. All columns stay as they are, whatever their names.

    Rows outside of any group of two pass without being shuffled.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(row, F.col("doc_id").cast("long").alias("did"), F.xxhash64(text).alias("th"), text.alias("text"))
    marked = stage(_marked(base), "fingerprints")
    roots = _roots(marked, base)
    rooted = marked.select("did", "th", "key").join(roots.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.select("did", "th", F.coalesce("root", "key").alias("root"))
    me = F.min(F.struct(F.isnull("did").alias("unnamed"), "did", "th")).alias("first")
    groups = stage(rooted.groupBy("root").agg(me, F.count(F.lit(1)).alias("n")), "groups", small=True)
    crowd = rooted.join(groups.where("n > 1").select("root"), "root", "left_semi")
    filter_ = stage(bit_filter(crowd, "did", "th"), "group-filter", small=True)
    chosen = stage(groups.select("first.did", "first.th"), "chosen", small=True)
    drop(marked, roots, groups)
    passed = passing(base.select("did", "th", "row"), filter_, "did", "th")
    grouped = passed.where("passes")
    same = grouped["did"].eqNullSafe(chosen["did"]) & (grouped["th"] == chosen["th"])
    kept = grouped.join(chosen, same, "left_semi").dropDuplicates(["did", "th"])
    return passed.where("not passes").select("row").union(kept.select("row")).select("row.*")
