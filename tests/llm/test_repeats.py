"""Repeated words and bytes against brute force."""

import hashlib
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from candlelake.llm import anchors, stages, suffix_array, substring_automaton

SCHEMA = "doc_id long, text string, th string, at int, low int"
SMALLEST = -(2**63)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)


def corpus(seed, docs=30, unit=" "):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)]
    shared = [list(rng.choice(words, rng.integers(15, 90))) for _ in range(8)]
    rows = []
    for i in range(docs):
        text = list(rng.choice(words, rng.integers(0, 120)))
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(0, len(text) + 1)
            text[at:at] = shared[rng.integers(len(shared))]
        rows.append((int(rng.integers(1, 10_000)) * docs + i, unit.join(text)))
    copy = list(rows[0][1].split(unit))
    copy[len(copy) // 2 : len(copy) // 2 + 1] = ["edit"]
    rows += [(7, rows[0][1]), (8, unit.join(copy)), (9, "a " * 150), (10, "a " * 90 + "b " * 90 + "a " * 60)]
    rows += [(11, None), (12, ""), (13, " \t\n"), (14, "xyz " * 70), (15, "é\x85\xa0日本 " * 60), (None, rows[1][1])]
    return rows


def slow_words(rows, window):
    seen = {}
    cut = [(SMALLEST if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, words in cut:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            seen[key] = min(seen.get(key, (d, i)), (d, i))
    out = []
    for (doc, _), (d, words) in zip(rows, cut):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] < (d, i):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def slow_bytes(rows, window):
    count = {}
    cut = [(d, (t or "").encode()) for d, t in rows]
    for _, raw in cut:
        for i in range(len(raw) - window + 1):
            count[raw[i : i + window]] = count.get(raw[i : i + window], 0) + 1
    out = []
    for doc, raw in cut:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - window + 1):
            if count[raw[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("most,block", [(1000, 1 << 19), (3, 300)])
def test_words(spark, monkeypatch, most, block):
    monkeypatch.setattr(anchors, "MOST_CLASSES", most)
    monkeypatch.setattr(anchors, "BLOCK", block)
    for seed in (1, 2):
        rows = corpus(seed)
        got = substring_automaton.remove_repeats(frame(spark, rows)).drop("kept").collect()
        assert sorted(map(tuple, got), key=key) == sorted(slow_words(rows, 20), key=key)


@pytest.mark.parametrize("most,block", [(1000, 1 << 19), (3, 1000)])
def test_bytes(spark, monkeypatch, most, block):
    monkeypatch.setattr(anchors, "MOST_CLASSES", most)
    monkeypatch.setattr(anchors, "BLOCK", block)
    for seed in (3, 4):
        rows = corpus(seed)
        got = suffix_array.remove_repeats(frame(spark, rows)).drop("kept").collect()
        assert sorted(map(tuple, got), key=key) == sorted(slow_bytes(rows, 200), key=key)


def test_single_cores_are_not_compared(spark, monkeypatch):
    """Texts that share a phrase, but no more around it, made four rows each in the comparison of classes."""
    compared, join_groups = [], anchors.join_groups

    def counted(rows, groups, key, size, total):
        if "near" in key:
            compared.append(rows.count())
        return join_groups(rows, groups, key, size, total)

    monkeypatch.setattr(anchors, "MOST_CLASSES", 3)
    monkeypatch.setattr(anchors, "join_groups", counted)
    rng = np.random.default_rng(21)
    own = ["".join(map(chr, rng.integers(97, 123, 300))) for _ in range(90)]
    phrase = "".join(map(chr, rng.integers(97, 123, 150)))
    rows = [(i, t[:150] + phrase + t[150:]) for i, t in enumerate(own)]
    rows += [(90, own[0][:120] + phrase + own[0][150:]), (91, own[1][10:150] + phrase + own[1][150:240])]
    got = suffix_array.remove_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow_bytes(rows, 200), key=key)
    # only two pairs of texts have more than the phrase in common
    assert compared and sum(compared) <= 100


def test_repeated_rows(spark):
    rng = np.random.default_rng(9)
    text = " ".join(rng.choice([f"w{i}" for i in range(999)], 80))
    rows = [(1, text), (1, text), (1, "other " + text), (2, None), (2, None)]
    got = substring_automaton.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [
        (1, 80, 0), (1, 80, 0), (1, 81, 80), (2, 0, 0), (2, 0, 0)
    ]
    got = suffix_array.remove_repeats(frame(spark, rows)).collect()
    assert sorted(r.n_bytes - r.n_removed for r in got) == [0, 0, 0, 0, 6]


def test_many_texts_under_one_id(spark, monkeypatch):
    """Hashes of texts that share an id may be equal; the texts still get their own spans."""
    monkeypatch.setattr(stages, "F", _Colliding())
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(999)]
    shared = " ".join(rng.choice(words, 45))
    rows = [(d, " ".join(rng.choice(words, 30)) + (" " + shared if i % 2 else "")) for i in range(12) for d in (None, 5)]
    rows += [(100 + i, shared) for i in range(3)]
    got = substring_automaton.remove_repeats(frame(spark, rows)).drop("kept").collect()
    # null ids come first, and of those, at equal places, one text
    want = [(d, len(t.split()), 45 if shared in t else 0) for d, t in rows]
    want[want.index((None, 75, 45))] = (None, 75, 0)
    assert sorted(((r.doc_id, r.n_words, r.n_removed) for r in got), key=key) == sorted(want, key=key)
    got = suffix_array.remove_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow_bytes(rows, 200), key=key)
    cut = suffix_array.cut_repeats(frame(spark, rows)).collect()
    assert sorted(len(r.text.encode()) for r in cut) == sorted(n - gone for _, n, gone, _, _ in slow_bytes(rows, 200))


class _Colliding:
    """The functions, with a short hash that gives one value for all."""

    def __getattr__(self, name):
        return getattr(F, name) if name != "hash" else lambda column: F.lit(7)


def test_cut_repeats_with_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, True, "a"), (2, text, False, None), (3, None, True, "c")], "doc_id long, text string, _no_text boolean, id string")
    out = suffix_array.cut_repeats(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect())) == [(1, "", True, "a"), (2, "", False, None), (3, None, True, "c")]


def test_empty(spark):
    empty = frame(spark, [])
    assert substring_automaton.remove_repeats(empty).count() == 0
    assert suffix_array.remove_repeats(empty).count() == 0


def test_reference(spark, monkeypatch):
    monkeypatch.setattr(substring_automaton, "SHARD_WORDS", 100)
    rows = [(i, t) for i, (_, t) in enumerate(corpus(5))]
    reference = [t for _, t in corpus(5)[:9]] + [None, ""]
    windows = {
        tuple(w[i : i + 20]) for t in reference if t for w in [t.split()] for i in range(len(w) - 19)
    }
    got = substring_automaton.remove_reference(
        frame(spark, rows), spark.createDataFrame([(t,) for t in reference], "text string")
    ).collect()
    for row in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", dict(rows)[row.doc_id] or "")
        gone = {j for i in range(len(words) - 19) if tuple(words[i : i + 20]) in windows for j in range(i, i + 20)}
        assert row.n_removed == len(gone)
    monkeypatch.setattr(substring_automaton, "MOST_REFERENCE_WORDS", 10)
    with pytest.raises(ValueError, match="too large"):
        substring_automaton.remove_reference(frame(spark, rows), spark.createDataFrame([(t,) for t in reference], "text string"))


def test_deep_shallow_sorts():
    rng = np.random.default_rng(0)
    stem = bytes(rng.integers(97, 99, 150, dtype=np.uint8))
    strings = [stem[: rng.integers(0, 150)] + bytes(rng.integers(97, 99, rng.integers(0, 60), dtype=np.uint8)) for _ in range(300)]
    strings += strings[:20]
    assert [strings[i] for i in suffix_array.deep_shallow(strings)] == sorted(strings)


def test_automaton_knows_first_places():
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 3, 30).tolist() for _ in range(6)]
    automaton, tag, first = substring_automaton.SuffixAutomaton(), 0, {}
    for s in sequences:
        automaton.add(s, tag)
        for i in range(len(s) - 3):
            first.setdefault(tuple(s[i : i + 4]), tag + i + 3)
        tag += len(s)
    probe = rng.integers(0, 3, 200).tolist()
    expected = [(i, first[tuple(probe[i - 3 : i + 1])]) for i in range(3, 200) if tuple(probe[i - 3 : i + 1]) in first]
    assert list(automaton.stream(probe, 4)) == expected
