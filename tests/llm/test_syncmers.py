"""Syncmers, edited texts and neighbours against plain Python."""

import hashlib
import math

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from candlelake.llm import syncmers

SCHEMA = "doc_id long, text string, th string, did int, sketch string"
DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff"
PYTHON_PIECES = rf"[{DENSE}]|[^ \t\n\x0b\f\r{DENSE}]{{1,8}}"


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(*values):
    """The library's hash of several longs: each is the seed of the next."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), h)
    return signed(h)


def slow_sketch(text, units):
    """Least rarity and the syncmers as (rarity, hash): place."""
    u = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in units]
    pairs = [chained(a, b) for a, b in zip(u, u[1:])]
    found = [(i, chained(pairs[i], pairs[i + 2])) for i in range(len(u) - 3) if min(pairs[i], pairs[i + 2]) <= pairs[i + 1]]
    found = found or [(0, signed(xxhash.xxh64_intdigest(text.encode(), 42)))]
    least = math.ceil(math.log2(max(1.0, math.sqrt(len(found)) / 8)))
    out = {}
    for place, h in found:
        top = (h & (2**64 - 1)) >> 48
        rare = 15 - math.floor(math.log2(max(top, 1)))
        if top < 2 ** (16 - least):
            key = (rare, h & 0x7FFF)
            out[key] = min(out.get(key, 1 << 13), place % (1 << 13))
    return least, out


def slow_sketches(text):
    ways = {}
    if len(text) <= 384:
        ways["c"] = slow_sketch(text, list(text) or [""])
    if len(text) > 256:
        ways["p"] = slow_sketch(text, regex.findall(PYTHON_PIECES, text))
    return ways


def slow_written(ways):
    one = lambda least, own: f"{least:x}" + "".join(sorted(f"{((r << 15 | h) << 13 | p):08x}" for (r, h), p in own.items()))
    return "-".join(name + one(*ways[name]) for name in ("c", "p") if name in ways)


def slow_likeness(a, b):
    way = next((w for w in ("c", "p") if w in a and w in b), None)
    if way is None:
        return 0.0
    least = max(a[way][0], b[way][0])
    x, y = ({k: p for k, p in s[way][1].items() if k[0] >= least} for s in (a, b))
    common = sorted((x[k], (y[k] - x[k]) % (1 << 13)) for k in set(x) & set(y))
    if min(len(x), len(y)) > 2:
        steady = [i for i, m in enumerate(common) if any(0 <= j < len(common) and common[j][1] == m[1] for j in (i - 1, i + 1))]
        common = steady
    return len(common) / (len(x) + len(y) - len(common)) if len(x) + len(y) > len(common) else 0.0


def rows():
    rng = np.random.default_rng(4)
    words = [f"wörd{i}" for i in range(500)] + ["incomprehensibilities"]
    out = [(10 * i, " ".join(rng.choice(words, 60 + i))) for i in range(12)]
    out += [(7, None), (3, ""), (5, "one two"), (6, "日本語のテキスト" * 5), (8, "z" * 300), (None, "no id at all, but words")]
    # so few runs that some texts have no syncmer
    out += [(1000 + i, " ".join(rng.choice(words, 5))) for i in range(20)]
    return out + [(4, "long " + " ".join(rng.choice(words, 30_000))), (20, "other text of this id"), (30, out[3][1])]


def expected(data):
    order = sorted({(d is not None, d or 0, t or "") for d, t in data}, reverse=True)
    out = {}
    for here, after in zip(order, order[1:] + order[:1]):
        text, n = here[2], len(here[2])
        edited = text[: n - n // 3] + after[2][: n // 3]
        out[here] = (n, hashlib.sha256(edited.encode()).hexdigest(), edited, after[2])
    return out


def test_edited_texts(spark):
    data = [r for r in rows() if r[0] != 20] + [(20, rows()[2][1])]
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in data], SCHEMA)
    got = syncmers.edited_fingerprints(docs).collect()
    assert len(got) == len(data)
    wanted = expected(data)
    print_of = {r.doc_id: r.fingerprint for r in got}
    text_of = {d: t or "" for d, t in data}
    for (known, doc, text), (n, digest, edited, after) in wanted.items():
        mine = [r for r in got if (r.doc_id is not None, r.doc_id or 0) == (known, doc)]
        assert mine and all((r.n_chars, r.edited_sha256) == (n, digest) for r in mine), doc
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in mine)
        if edited == text:
            assert mine[0].near_edited == 1.0
    assert print_of[30] == print_of[20 if text_of[30] == text_of[20] else 30]
    assert print_of[7] == print_of[3]
    long = [r for r in got if r.doc_id is not None and 1000 > r.doc_id >= 40 and r.doc_id % 10 == 0]
    assert np.mean([r.near_edited for r in long]) > 0.3 > 0.1 > np.mean([r.near_next for r in long])


def test_repeated_rows_share_a_place(spark):
    data = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "h i j k l m n"), (2, None)]
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in data], SCHEMA)
    got = syncmers.edited_fingerprints(docs).collect()
    assert len(got) == 4
    assert len({(r.edited_sha256, r.fingerprint) for r in got if r.doc_id == 1}) == 1
    alone = syncmers.edited_fingerprints(docs.limit(1)).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert syncmers.edited_fingerprints(docs.limit(0)).count() == 0


def varied():
    """Short, space-free and long texts, in several scripts."""
    rng = np.random.default_rng(21)
    words = [f"wörd{i}" for i in range(500)] + ["incomprehensibilities", "日本語", "ไทย", "x"]
    out = ["", " ", "a", "ab", "abc", "abcd", "hello world", "none", "None ", "  two  words ", "é" * 12, "日本語のテキスト", "\n\n"]
    out += [" ".join(rng.choice(words, n)) for n in (1, 2, 3, 4, 5, 7, 9, 12, 19, 30, 40, 45, 50, 55, 60, 80, 200, 900, 3000)]
    out += ["".join(rng.choice(list("abcdef0123456789"), n)) for n in (20, 255, 256, 257, 300, 383, 384, 385, 500, 4000)]  # no white space
    out += ["".join(rng.choice(list("日本語のテキスト漢字仮名"), n)) for n in (10, 300, 2000)] + ["aaaa " * 700, "z" * 5000]
    return out


def test_fingerprints_equal_brute_force(spark):
    texts = varied()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    order = list(range(len(texts)))[::-1]
    after = dict(zip(order, order[1:] + order[:1]))
    for r in syncmers.edited_fingerprints(docs).collect():
        text, other = texts[r.doc_id], texts[after[r.doc_id]]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        own, changed, theirs = (slow_sketches(t) for t in (text, edited, other))
        assert (r.fingerprint, r.edited_fingerprint) == (slow_written(own), slow_written(changed)), text[:50]
        assert r.near_edited == pytest.approx(slow_likeness(own, changed), abs=1e-12), text[:50]
        assert r.near_next == pytest.approx(slow_likeness(own, theirs), abs=1e-12), text[:50]


def test_edited_texts_stay_alike_at_any_length(spark):
    """Two thirds of each text are unchanged; texts of a few characters and texts without white space are no exception."""
    rng = np.random.default_rng(2)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    texts = ["".join(rng.choice(letters + [" "] * 5, n)) for n in [14, 20, 30, 60, 120, 250, 258, 300, 380, 390, 500, 2000, 30_000] * 4]
    texts += ["".join(rng.choice(letters, n)) for n in [14, 30, 250, 260, 390, 3000] * 4]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = syncmers.edited_fingerprints(docs).toPandas()
    n = got.n_chars
    assert (got.near_edited[n >= 20] > 0).all() and got.near_edited[n < 20].mean() > 0.2
    assert got.near_edited[n >= 60].min() > 0.25 and 0.4 < got.near_edited[n >= 60].mean() < 0.6
    assert got.near_next.max() < 0.1


def test_passage_of_a_few_per_cent_is_seen(spark):
    """Fingerprints grow with the text, so a passage of 3 % of a long text leaves a trace, at whatever place it stands."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(50_000)]
    passage = list(rng.choice(words, 450))
    texts = [" ".join([*rng.choice(words, a), *passage, *rng.choice(words, b)]) for a, b in ((14_000, 550), (300, 14_250))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    ways = [slow_sketches(t) for t in texts]
    assert len(ways[0]["p"][1]) > 300
    got = syncmers.edited_fingerprints(docs).orderBy("doc_id").collect()
    assert got[0].near_next > 0.005 and got[1].near_next == pytest.approx(got[0].near_next)


def test_syncmers_are_context_free(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    shared = " ".join(rng.choice(words, 60))
    texts = [shared, " ".join(rng.choice(words, 17)) + " " + shared + " tail", shared + " " + " ".join(rng.choice(words, 31))]
    text = F.col("text")
    found = spark.createDataFrame([(t,) for t in texts], "text string").select(syncmers.syncmers(text, syncmers.pieces_of(text)).alias("s")).collect()
    hashes = [{s["hash"] for s in r.s} for r in found]
    assert hashes[0] and hashes[0] <= hashes[1] and hashes[0] <= hashes[2]
    starts = [[s["place"] for s in r.s] for r in found]
    assert all(p == sorted(p) for p in starts)
    # a run is chosen by its three pairs alone: about two thirds of all runs
    assert 0.5 < len(starts[0]) / 57 < 0.85


def test_pieces(spark):
    texts = [t for _, t in rows() if t and len(t) < 3000] + [" \n a b\t", "ไทย and ไทย"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(syncmers.pieces_of(F.col("text")).alias("u"))
    assert [r.u for r in got.collect()] == [regex.findall(PYTHON_PIECES, t) for t in texts]
