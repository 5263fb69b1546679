"""The pipeline's near-dedup against the Jaccard index of all pairs."""

from collections import defaultdict

import corpus_pipeline
import numpy as np

from candlelake.llm import near_copies

SCHEMA = "doc_id long, text string, key string, root int"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """The least id of every group, and the groups."""
    sets = [shingles(t) for _, t in rows]
    label, holders = list(range(len(rows))), defaultdict(list)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x]} | {j for j in range(i) if not s and not sets[j]}:
            common = len(s & sets[j])
            if common >= 0.8 * (len(s) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                label[b] = a
        for x in s:
            holders[x].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    return sorted(min(g) for g in groups.values()), groups


def test_given_documents(spark):
    """Pairs of a Jaccard index of 0.8 differ in up to 10 of 64 bits or more: four bits kept both."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, _ = slow_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()) == kept


def test_edited_copies_and_crowds(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(900)]
    rows = []
    for n in (4, 5, 7, 9, 12, 20, 30, 60, 200, 900):
        for _ in range(12):
            text = list(rng.choice(words, n))
            rows.append(" ".join(text))
            # one run of foreign words in the middle, or words at the end
            cut = max(1, n // 14)
            rows.append(" ".join(text[: n // 2] + ["X"] * max(0, cut - 4) + text[n // 2 + max(0, cut - 4) :]))
            rows.append(" ".join(text + list(rng.choice(words, cut))))
    base = list(rng.choice(words, 250))
    for _ in range(150):  # a crowd, of which some are near and some are not
        text = list(base)
        for _ in range(rng.integers(1, 9)):
            text[rng.integers(250)] = str(rng.choice(words))
        rows.append(" ".join(text))
    rows += ["", " \n", None, "A b", "a B"]
    data = [(2000 - i, t) for i, t in enumerate(rows)]
    wanted, groups = slow_kept(data)
    got = sorted(r.doc_id for r in near_copies.keep_one(spark.createDataFrame([(*r, "k", 1) for r in data], SCHEMA)).collect())
    assert set(wanted) <= set(got)  # nothing unique goes
    # 99 % of pairs at the very edge
    assert len(got) - len(wanted) <= 0.01 * sum(len(g) > 1 for g in groups.values())


def test_repeated_and_null_ids(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, one), (1, two), (1, one), (None, one), (None, "c d"), (None, "C d"), (2, two + " more")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text.lower()) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, one), (1, two), (None, "c d")], key=str)
    assert near_copies.keep_one(docs.limit(0)).count() == 0


def test_crowd_of_unlike_texts(spark, monkeypatch):
    """Texts that are near by their bits but too unlike were tested pair by pair, up to all pairs of the crowd."""
    tested, verified = [], near_copies._verified

    def counted(pairs, sets):
        tested.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", counted)
    rng = np.random.default_rng(31)
    words = [f"w{i}" for i in range(5000)]
    base, rows = list(rng.choice(words, 300)), []
    for i in range(300):  # two of them share about 0.7
        text = list(base)
        for at in rng.choice(60, 5, replace=False):
            text[at * 5] = f"own{i}"
        rows.append(" ".join(text))
    for i in range(0, 300, 50):
        rows.append(rows[i].replace(base[299], "other"))
    data = list(enumerate(rows, 1))
    wanted, groups = slow_kept(data)
    assert 200 < len(wanted) <= 300
    got = sorted(r.doc_id for r in near_copies.keep_one(spark.createDataFrame([(*r, "k", 1) for r in data], SCHEMA)).collect())
    assert got == wanted
    assert sum(tested) < 300 * 299 / 2 / 4


def test_crowd_of_two_groups(spark, monkeypatch):
    """Texts of a crowd met again in all buckets that are crowded, and pairs that are too unlike were tested wherever they were nearest."""
    met, tested, dealt, verified = [], [], near_copies._dealt, near_copies._verified

    def counted(rows):
        met.append(rows.count())
        return dealt(rows)

    def counted_pairs(pairs, sets):
        tested.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_dealt", counted)
    monkeypatch.setattr(near_copies, "_verified", counted_pairs)
    rng = np.random.default_rng(47)
    words = [f"w{i}" for i in range(5000)]
    base, rows = list(rng.choice(words, 300)), []
    for i in range(400):
        text = list(base)
        if i % 2:  # of the other group: near by its bits, an index of about 0.73
            for at in range(0, 45, 5):
                text[at] = f"other{at}"
        text[100 + int(rng.integers(200))] = f"own{i}"
        rows.append(" ".join(text))
    data = list(enumerate(rows, 1))
    wanted, groups = slow_kept(data)
    assert len(groups) == 2
    got = sorted(r.doc_id for r in near_copies.keep_one(spark.createDataFrame([(*r, "k", 1) for r in data], SCHEMA)).collect())
    assert got == wanted
    assert sum(met[1:]) < 30 * len(rows)
    assert sum(tested) < 13 * len(rows)
