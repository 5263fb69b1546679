"""Removing repeated word windows with suffix automata.

An automaton of a reference shard recognises every word string of the shard and
knows where each occurs first. Streaming a document through it gives, at every word, the longest match
that ends there; where that is ``window`` words or more, the words are covered.

``remove_reference`` broadcasts the automata of a reference whose size is checked. For repeats
inside a corpus the reference is the corpus itself, which no broadcast could hold: there the
shards are the contested passages of ``anchors``, a bounded number each, and an automaton meets just the
passages of its own shard, the only ones that it can match.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm import anchors
from candlelake.llm.hashing import word_hashes, words_of
from candlelake.llm.stages import doc_id, keyed_docs, map_arrow, numbered

GRAM = 8
# words of a broadcast reference, in all and in one shard
MOST_REFERENCE_WORDS = 2_000_000
SHARD_WORDS = 100_000


class SuffixAutomaton:
    """Suffix automaton of several word sequences. ``first[state]`` is the tag of its earliest end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [-1]

    def _state(self, moves: dict[int, int], link: int, length: int, tag: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(tag)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A state for the strings of ``child`` that are no longer than those of ``parent`` and a word."""
        length = self.length[parent] + 1
        clone = self._state(dict(self.next[child]), self.link[child], length, self.first[child])
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def add(self, words: list[int], tag: int) -> None:
        """Add a sequence; its ``i``-th word has the tag ``tag + i``. Earlier tags must be added first."""
        last, moves, link, length = 0, self.next, self.link, self.length
        for word in words:
            child = moves[last].get(word)
            if child is not None:
                last = child if length[child] == length[last] + 1 else self._split(last, word, child)
            else:
                new = self._state({}, 0, length[last] + 1, tag)
                parent = last
                while parent >= 0 and word not in moves[parent]:
                    moves[parent][word] = new
                    parent = link[parent]
                if parent >= 0:
                    child = moves[parent][word]
                    link[new] = child if length[child] == length[parent] + 1 else self._split(parent, word, child)
                last = new
            tag += 1

    def stream(self, words: list[int], window: int):
        """``(place, tag)`` for every word that ends a known string of ``window`` words: the tag of its first end."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for place, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            child = moves[state].get(word)
            if child is None:
                continue
            state = child
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                yield place, self.first[state]


def _solver(window: int):
    def solve(rows):
        """Passages of a shard in ascending order of their place; later ones give way to earlier ones."""
        order = sorted(range(len(rows)), key=lambda i: (*rows[i][1:3], rows[i][5]))
        shard, tag, passages = SuffixAutomaton(), 0, []
        for i in order:
            words = np.frombuffer(rows[i][4], np.int64).tolist()
            passages.append((i, tag, words))
            shard.add(words, tag)
            tag += len(words)
        # where the tag's word lies: document and place
        sizes = [len(p[2]) for p in passages]
        docs, texts = (np.repeat([rows[i][c] for i in order], sizes).tolist() for c in (1, 5))
        places = np.concatenate(
            [np.arange(len(words)) + rows[i][2] - rows[i][3] for i, _, words in passages]
        ).tolist()
        for i, _, words in passages:
            did, begin, text = rows[i][1], rows[i][2] - rows[i][3], rows[i][5]
            low = high = None
            for place, first in shard.stream(words, window):
                end = begin + place
                if (docs[first], places[first], texts[first]) >= (did, end, text):
                    continue
                if high == end:
                    high = end + 1
                    continue
                if high is not None:
                    yield i, low, high
                low, high = end + 1 - window, end + 1
            if high is not None:
                yield i, low, high

    return solve


def repeated_spans(keyed: DataFrame, window: int = 20) -> DataFrame:
    """``did, th, low, high``: spans of words whose union is every window that starts earlier too."""
    if window <= GRAM:
        raise ValueError(f"window must be more than {GRAM}")
    units = anchors.Units("words", window, GRAM)
    found = anchors.search(keyed, units, keep_first=True)
    return anchors.solve(found, keyed.sparkSession, _solver(window), most=500)


def _cut(window: int):
    def cut(batch):
        out = []
        for text, (low, high) in zip(batch["text"], anchors.spans_of(batch)):
            words = text.as_py().encode().split()
            spans = anchors.covered(low, high, len(words), window)
            ends = [0, *(x for s in spans for x in s), len(words)]
            kept = [w for a, b in zip(ends[::2], ends[1::2]) for w in words[a:b]]
            joined = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()))
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch["did"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["did", "n_words", "n_removed", "kept_sha256", "kept"],
        )

    return cut


_RESULT = "did long, n_words long, n_removed long, kept_sha256 string, kept string"


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(doc_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every row.

    Words are runs without the white space bytes 0x20 and 0x09-0x0D. A word is removed if a window of
    ``window`` consecutive words covers it whose sequence also starts earlier: in a row of a smaller id, or
    earlier in the same row. Windows are judged on the input. ``kept`` joins the remaining words by a space. A
    null text has no words; a null id comes before all others. Of rows with one id neither is earlier, unless
    their texts differ: then a repeat counts as earlier by its place in the text, at equal places by a number of the text. An empty table
    gives no rows.
    """
    keyed = numbered(keyed_docs(docs))
    joined = anchors.with_spans(keyed, repeated_spans(keyed, window))
    return _result(map_arrow(joined.select("did", "text", "lows", "highs"), _cut(window), _RESULT))


def remove_reference(docs: DataFrame, reference: DataFrame, window: int = 20) -> DataFrame:
    """As ``remove_repeats``, but for windows that occur in a text of ``reference`` (a column ``text``).

    The automata are broadcast, one per ``SHARD_WORDS`` words. A reference of more than ``MOST_REFERENCE_WORDS``
    words is refused. A reference text is in one shard, so no match crosses shards.
    """
    spark = docs.sparkSession
    texts = reference.where("text is not null").select("text")
    count = F.size(F.split(F.trim(F.col("text")), r"[\x20\x09-\x0D]+"))
    words = texts.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first()["n"]
    if words > MOST_REFERENCE_WORDS:
        raise ValueError(f"a reference of {words} words is too large to broadcast")
    shards, filled = [], SHARD_WORDS
    for row in texts.toLocalIterator():
        if filled >= SHARD_WORDS:
            shards.append([])
            filled = 0
        hashes = _hashes(row["text"])
        shards[-1].append(hashes)
        filled += len(hashes)
    sent = [spark.sparkContext.broadcast(s) for s in shards]
    built: dict[int, SuffixAutomaton] = {}

    def automata():
        for number, shard in enumerate(sent):
            if number not in built:
                built[number] = SuffixAutomaton()
                for sequence in shard.value:
                    built[number].add(sequence, 0)
            yield built[number]

    def match(batch):
        lows, highs = [], []
        for text in batch["text"]:
            hashes = _hashes(text.as_py())
            ends = sorted({place + 1 for a in automata() for place, _ in a.stream(hashes, window)})
            lows.append([e - window for e in ends])
            highs.append(ends)
        yield from _cut(window)(
            pa.RecordBatch.from_arrays(
                [batch["did"], batch["text"], pa.array(lows, pa.list_(pa.int32())), pa.array(highs, pa.list_(pa.int32()))],
                names=["did", "text", "lows", "highs"],
            )
        )

    return _result(map_arrow(keyed_docs(docs).select("did", "text"), match, _RESULT))


def _hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(data)])
    starts, _ = words_of(data, offsets)
    return word_hashes(data, offsets, starts).view(np.int64).tolist()


def oracle(window: int = 20) -> str:
    """``remove_repeats`` of ``documents`` with distinct ids, without ``kept``, as SQL."""
    return rf"""
        WITH texts AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), places AS (
            SELECT doc_id, words, unnest(range(1, len(words) - {window - 2})) AS place FROM texts WHERE len(words) >= {window}
        ), windows AS (
            SELECT doc_id, place, md5(array_to_string(words[place : place + {window - 1}], ' ')) AS digest FROM places
        ), ranked AS (
            SELECT doc_id, place, row_number() OVER (PARTITION BY digest ORDER BY doc_id, place) AS r FROM windows
        ), gone AS (
            SELECT DISTINCT doc_id, place + j AS place FROM ranked, (SELECT unnest(range({window})) AS j) WHERE r > 1
        ), spread AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
            FROM spread ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """
