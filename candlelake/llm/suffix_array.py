"""Removing repeated byte strings with sparse suffix arrays built by deep-shallow sorting.

Suffixes are sorted where a repeat can be anchored (``anchors``), not at every byte. The
suffixes of one anchor are ordered by multikey quicksort down to a shallow depth; groups that still
agree there, which have long common prefixes, are ordered by blind tries. The longest common
prefixes of neighbours then give, for every pair of suffixes, how far they agree to the
right; agreement to the left is looked up among the nearest reversed prefixes while the groups of
falling prefix length are merged. A pair that agrees over ``min_bytes`` or more marks both places.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm import anchors
from candlelake.llm.stages import doc_id, keyed_docs, map_arrow, told_apart

GRAM = 32
# bytes compared by quicksort, a few at a time, before blind tries take over
SHALLOW, STEP = 96, 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class BlindTrie:
    """A trie of branching places only: inner nodes keep a depth and one byte per branch.

    A new string walks down by its branching bytes alone, is compared once with the leaf
    that it meets, and is hung in at the depth where the two part.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None

    @staticmethod
    def _byte(string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    def add(self, number: int) -> None:
        if self.root is None:
            self.root = [number]
            return
        new, node = self.strings[number], self.root
        while isinstance(node, tuple):
            depth, branches = node
            node = branches.get(self._byte(new, depth)) or next(iter(branches.values()))
        old = self.strings[node[0]]
        depth = common_prefix(old, new)
        if depth == len(old) == len(new):
            node.append(number)
            return
        parent, at, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, at = node, self._byte(new, node[0])
            node = node[1][at]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._byte(new, depth)] = [number]
            return
        inner = (depth, {self._byte(old, depth): node, self._byte(new, depth): [number]})
        if parent is None:
            self.root = inner
        else:
            parent[1][at] = inner

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Numbers of ``strings`` in ascending order; equal strings keep their order."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.extend(group)
        elif depth >= SHALLOW:
            trie = BlindTrie(strings)
            for number in group:
                trie.add(number)
            out.extend(trie.order())
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + STEP]
            less, equal, more = [], [], []
            for number in group:
                piece = strings[number][depth : depth + STEP]
                (less if piece < pivot else more if piece > pivot else equal).append(number)
            if more:
                stack.append((more, depth))
            # a short pivot ends its strings: they are equal
            stack.append((equal, depth + STEP if len(pivot) == STEP else SHALLOW))
            if less:
                stack.append((less, depth))
    return out


def repeats_of_group(lefts: list[bytes], rights: list[bytes], window: int):
    """``(number, left, right)``: context ``number`` agrees with another over ``left + right >= window`` bytes.

    ``lefts`` are the bytes before the anchor, reversed; ``rights`` those from it on. The spans given for a
    context cover every byte that any such agreement covers.
    """
    order = deep_shallow(rights)
    n = len(order)
    prefixes = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    rank = {number: i for i, number in enumerate(sorted(range(n), key=lefts.__getitem__))}
    by_rank = sorted(range(n), key=rank.__getitem__)
    # sets of neighbours in the array, as sorted ranks of their left sides
    owner = list(range(n))
    sets = {i: [rank[number]] for i, number in enumerate(order)}

    def find(i):
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i in sorted(range(n - 1), key=lambda i: -prefixes[i]):
        right = prefixes[i]
        a, b = find(i), find(i + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        big, small = sets[a], sets.pop(b)
        owner[b] = a
        # the nearest left side in the other set is the best of it
        for x in small:
            place = bisect.bisect_left(big, x)
            for y in big[max(0, place - 1) : place + 1]:
                one, two = by_rank[x], by_rank[y]
                left = common_prefix(lefts[one], lefts[two])
                if left + right >= window:
                    yield one, left, right
                    yield two, left, right
        sets[a] = list(_merged(big, small))


def _merged(a: list[int], b: list[int]) -> list[int]:
    if len(b) * 8 < len(a):
        for x in b:
            bisect.insort(a, x)
        return a
    return sorted(a + b)


def _solver(window: int):
    def solve(rows):
        low = 0
        while low < len(rows):
            high = low
            while high < len(rows) and rows[high][0] == rows[low][0]:
                high += 1
            group = rows[low:high]
            lefts = [raw[:left][::-1] for _, _, _, left, raw, _ in group]
            rights = [raw[left:] for _, _, _, left, raw, _ in group]
            for number, left, right in repeats_of_group(lefts, rights, window):
                place = group[number][2]
                yield low + number, place - left, place + right
            low = high

    return solve


def repeated_spans(keyed: DataFrame, min_bytes: int = 200) -> DataFrame:
    """``did, th, low, high``: spans whose union is every byte covered by a repeated ``min_bytes`` string."""
    if min_bytes <= GRAM:
        raise ValueError(f"min_bytes must be more than {GRAM}")
    units = anchors.Units("bytes", min_bytes, GRAM)
    found = anchors.search(keyed, units, keep_first=False)
    return anchors.solve(found, keyed.sparkSession, _solver(min_bytes), most=256)


def remove_repeats(docs: DataFrame, min_bytes: int = 200) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row.

    Every byte that lies in a ``min_bytes``-byte string which starts anywhere else too, in the same or
    another row, is removed from all of these places; ``kept`` holds the remaining bytes. Strings never cross
    rows and are judged on the input. A null text is empty; a null id counts as an id. Rows that
    repeat a whole row are texts of their own, so they remove each other. An empty table gives no rows.
    """
    keyed = told_apart(keyed_docs(docs))
    joined = anchors.with_spans(keyed, repeated_spans(keyed, min_bytes))

    def cut(batch):
        out = [
            (len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept)
            for raw, kept, n in _kept(batch, min_bytes)
        ]
        columns = list(zip(*out))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )

    schema = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    done = map_arrow(joined.select("id", "text", "lows", "highs"), cut, schema)
    return done.select(doc_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def _kept(batch: pa.RecordBatch, min_bytes: int):
    """For each row: its bytes, what remains of them, and the number of removed runs."""
    for text, (low, high) in zip(batch["text"], anchors.spans_of(batch)):
        raw = text.as_py().encode()
        spans = anchors.covered(low, high, len(raw), min_bytes)
        ends = [0, *(x for s in spans for x in s), len(raw)]
        yield raw, b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2])), len(spans)


def cut_repeats(docs: DataFrame, min_bytes: int = 200) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``, and ``n_chars``, if there, counted anew.

    As ``remove_repeats``; a character that loses some of its bytes goes whole. Texts without a repeat, nulls
    among them, stay as they are, and so do all other columns, whatever their names. Very long texts are cut like any other. An empty
    table gives no rows.
    """
    columns = docs.columns
    no_text = "_no_text"
    while no_text in columns:
        no_text = f"_{no_text}"
    # the text travels once, beside the other columns
    others = F.struct(*(F.col(f"`{c}`") for c in columns if c != "text"), F.col("text").isNull().alias(no_text))
    rows = docs.select(others.alias("row"), "doc_id", "text")
    joined = anchors.with_spans(told_apart(keyed_docs(rows, "row")), repeated_spans(told_apart(keyed_docs(docs)), min_bytes))
    fields = [T.StructField("kept", T.StringType()), T.StructField("is_cut", T.BooleanType())]
    schema = T.StructType([*rows.select("row").schema.fields, *fields])

    def cut(batch):
        found = [(kept.decode("utf-8", "ignore"), n > 0) for _, kept, n in _kept(batch, min_bytes)]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.bool_())],
            names=["row", "kept", "is_cut"],
        )

    done = map_arrow(joined.select("row", "text", "lows", "highs"), cut, schema)
    values = {c: F.col(f"row.`{c}`") for c in columns if c != "text"}
    values["text"] = F.when(~F.col(f"row.{no_text}"), F.col("kept"))
    if "n_chars" in values:
        counted = F.length("kept").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(F.col("is_cut"), counted).otherwise(values["n_chars"])
    return done.select(*(values[c].alias(c) for c in columns))
