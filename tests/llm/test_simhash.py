"""Fingerprints and groups against brute force."""

import re

import numpy as np
import xxhash

from candlelake.llm import simhash
from candlelake.llm.components import components

SCHEMA = "doc_id long, text string, fp string, component_id int, bucket int"


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, max_bits=4):
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fps[i] ^ fps[j]).count("1") <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, f"{fps[i]:016x}", min(ids, default=None)))
    return out


def key(row):
    return tuple(map(str, row))


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    got = [tuple(r) for r in simhash.near_groups(docs).collect()]
    assert sorted(got, key=key) == sorted(slow_groups(rows), key=key)


def test_groups(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        text = list(rng.choice(words, 200))
        for copy in range(4):
            for _ in range(copy):
                text[rng.integers(200)] = "Edit"
            rows.append((1000 - len(rows), " ".join(text)))
    rows += [(5, None), (3, ""), (4, " \t\n"), (None, "only a few"), (None, None), (9, "Only A FEW"), (9, "only a few")]
    rows += [(2000, "é \x85 \xa0x y z"), (2001, "long " * 70000)]
    check(spark, rows)


def test_large_bucket_matches_small_ones():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 63, 5)]))
    one, two = simhash._Forest(), simhash._Forest()
    simhash._link_block(fps, fps, 4, one)
    for x in fps.tolist():
        for y in fps.tolist():
            if x != y and (x ^ y).bit_count() <= 4:
                two.link(x, y)
    assert [one.root(x) for x in fps.tolist()] == [two.root(x) for x in fps.tolist()]
    assert len(one.links) == len(two.links)


def test_every_near_pair_meets_in_a_bucket(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(50):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, 4, replace=False):
            y ^= 1 << int(b)
        pairs.append((x, y))
    fps = spark.createDataFrame([(simhash._signed(v),) for p in pairs for v in p], "fp long")
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in simhash.links(fps).collect()}
    assert {frozenset(p) for p in pairs} <= found


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_empty_table(spark):
    assert simhash.near_groups(spark.createDataFrame([], SCHEMA)).count() == 0
