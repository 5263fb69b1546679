"""Id files and packing against direct encoding; coding round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlelake.llm import packing, simple8b, tokens
from candlelake.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, part int, words string, curve long"
TEXTS = [
    None,
    "",
    " \n\t ",
    "Hello, world! it's 2024's <|endoftext|>x <|ENDOFTEXT|>",
    "É Écoles,ÉÀ Σας ΣΑΣ İstanbul é É x y\x1cz\x85w",
    "日本語 テキスト。 ünï-cödé ﬁ ½ 12.5, a.b.c;;",
    "word " * 3000,
    "x" * 5000,
    "same text",
    "same text",
]


def expected(text):
    t = Tokenizer.from_file(VOCABULARY)
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, None, i, "clash", None) for i, t in enumerate(TEXTS)] + [(None, "no id", "en", 0, "", 1)]
    return spark.createDataFrame(rows + [(27, "same text", None, 0, None, 2)], SCHEMA)


@given(st.lists(st.one_of(st.just(0), st.integers(0, 60), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    coded = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(coded.words, coded.escapes).tolist() == values


def test_simple8b_marks_allow_partial_decoding():
    values = np.random.default_rng(0).integers(0, 50_000, 9000).astype(np.uint64)
    coded = simple8b.encode(values)
    k = 3
    assert (simple8b.decode(coded.words[k * simple8b.MARK_EVERY :]) == values[coded.marks[k] :]).all()
    zeros = simple8b.encode(np.zeros(240, np.uint64))
    assert len(zeros.words) == 1


def test_chunks_encode_like_whole_texts():
    for text in TEXTS:
        assert tokens.document_ids(VOCABULARY, text) == expected(text).tobytes()


def test_token_file(docs):
    got = tokens.token_file_report(docs, VOCABULARY).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text) for r in docs.collect()), key=lambda x: x[:2])
    assert len(got) == len(rows)
    got = sorted(got, key=lambda r: r.start)
    start = 0
    for (known, doc, text), row in zip(rows, got):
        ids = expected(text)
        assert (row.doc_id, row.start, row.n_tokens) == (doc if known else None, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_packing(docs):
    pieces = packing.pack(docs, VOCABULARY, capacity=64).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert p.ids_crc32 == zlib.crc32(p.ids) and p.length * 4 == len(p.ids)
    total = sum(len(expected(r.text)) for r in docs.collect())
    assert sum(p.length for p in pieces) == total
    for number, sequence in by_sequence.items():
        at = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 64 or number == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    longest = expected(TEXTS[6])
    own = sorted(by_doc[(18, len(longest))], key=lambda p: p.start)
    assert b"".join(p.ids for p in own) == longest.tobytes()


def test_hilbert_neighbours_touch():
    """Consecutive keys are neighbouring cells, and every cell has its own key."""
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, bits=3)
    assert sorted(keys) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_alike_texts_lie_together():
    a, b = "the cat sat on the mat " * 20, "der hund lief in das haus " * 20
    data = np.frombuffer((a + a + b).encode(), np.uint8)
    points = packing.points_of(data, np.array([0, len(a), 2 * len(a), len(data)]))
    assert (points[0] == points[1]).all() and (points[0] != points[2]).any()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tokens.token_file_report(empty, VOCABULARY).count() == 0
    assert packing.pack(empty, VOCABULARY).count() == 0


PARTS = st.sampled_from(["the", "École", "é", "É.", "it's", "'re", "12", "a.b", "x" * 30, "ß,", "İ", "Å", "é", "日本", "½", "\x85", "\x1c", "\x00", "<|endoftext|>", "…", ";;;"])


@settings(deadline=None)
@given(st.lists(st.lists(st.one_of(PARTS, st.text(max_size=6), st.sampled_from([" ", "\n", "\t\x0b"])), max_size=12).map("".join), min_size=1, max_size=6))
def test_batches_encode_like_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    coder = tokens.encoder(VOCABULARY)
    ids, counts = coder.encode_all(pa.array([*texts, None], pa.string()))
    ends = np.cumsum(counts)
    assert counts[-1] == 0
    for text, end, count in zip(texts, ends, counts):
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[end - count : end].tolist() == want
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == want


def test_blocks_hold_whole_documents(spark):
    rows = [(i, "word " * (i * 37 % 900)) for i in range(400)] + [(1000, "long " * 40_000)]
    file = tokens.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY)
    blocks = file.orderBy("part", "block").collect()
    assert [d for b in blocks for d in b.doc_ids] == sorted(r[0] for r in rows)
    last = {b.part: b.block for b in blocks}
    for b in blocks:
        assert b.ends[-1] == b.n_ids and (b.n_ids >= tokens.BLOCK_IDS or b.block == last[b.part])
        assert len(b.ends) == 1 or b.ends[-2] < tokens.BLOCK_IDS
    got = tokens.read_ids(file).collect()
    assert {r.doc_id: r.ids for r in got} == {d: expected(t).tobytes() for d, t in rows}


def test_crowded_id_is_split(spark):
    """A third of the rows share an id: their texts range over several tasks, and the file keeps its order."""
    rows = [(5 if i % 3 == 0 else i, f"text {i}") for i in range(900)] + [(None, "x y")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert tokens._crowded(docs, 8) and not tokens._crowded(docs.where("doc_id <> 5"), 8)
    blocks = tokens.write_ids(docs, VOCABULARY).orderBy("part", "block").collect()
    ids = [d for b in blocks for d in b.doc_ids]
    assert ids == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert len({b.part for b in blocks if 5 in b.doc_ids}) > 1


def test_stretches_of_the_curve_hold_equal_bytes(spark):
    """Long texts that lie together on the curve are dealt to several tasks."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choice(words, 4000 if i < 60 else 5))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    splitters = packing._splitters(docs, 8)
    keys = packing.curve_keys(docs).collect()
    stretch = packing._stretch(splitters, np.array([k.curve for k in keys]), np.array([k.tie for k in keys]))
    sizes = np.bincount(stretch, weights=[len(k.text) for k in keys])
    assert len(sizes) == 8 and sizes.max() < 1.5 * sizes.sum() / 8
    order = sorted(range(len(keys)), key=lambda i: (keys[i].curve, keys[i].tie))
    assert (np.diff(stretch[order]) >= 0).all()


def test_ranges_do_not_change_the_packing(spark, monkeypatch):
    rows = [(i, "a b c " * (i % 40)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, packing.pack(docs, VOCABULARY).collect()))
    monkeypatch.setattr(packing, "SAMPLE", 10)
    assert sorted(map(tuple, packing.pack(docs, VOCABULARY).collect())) == want


def test_long_texts_are_cut_between_chunks(monkeypatch):
    monkeypatch.setattr(tokens, "_BATCH", 50)
    texts = ["don't stop, É. " * 30, "x" * 400, "a b", None, "tail " * 9 + "<|endoftext|>" + " z" * 40, " \n" * 60]
    (ids, counts) = zip(*[(i, c) for _, _, i, c in tokens.ids_of_batch(VOCABULARY, pa.array(texts, pa.string()))])
    ids, ends = np.concatenate(ids), np.cumsum(np.concatenate(counts))
    for text, low, high in zip(texts, [0, *ends], ends):
        assert ids[low:high].tolist() == expected(text).tolist()
