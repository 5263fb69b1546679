"""Token ids of texts, and an id file of Simple-8b coded blocks.

Ids come from the tokenizers library. Its vocabulary here drops white space, so
the ids of a text are those of its white-space separated chunks in turn. A batch of texts is cut into chunks by Arrow, each distinct
chunk is looked up once, and chunks never seen before are encoded piece by piece; the ids are then put together as arrays.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm import simple8b
from candlelake.llm.stages import give_back, giving_back, map_arrow, parts, runs_of_rows, stage, starts_of_parts

END_ID = 1
# chunks kept per Python worker (about 200 bytes each)
MEMO_CHUNKS = 300_000
BLOCK_IDS = 16_384
# rows of whole texts that a worker gets at a time
_ARROW_ROWS = 2000
# bytes of texts that are cut into chunks at a time; a longer text is cut at white space
_BATCH = 1 << 21
# signs that never share a piece with a letter or digit before them: all but the apostrophe
_TAIL = string.punctuation.replace("'", "").encode()
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
# how the vocabulary cuts chunks, as far as they are lower-case ASCII
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """``encode(text bytes)`` gives the ids of a text, ``encode_all(texts)`` those of many, both as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo: dict[bytes, bytes] = {}
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.alphabet = {b: chr(b if b in plain else next(others)) for b in range(256)}

    def encode(self, text: bytes) -> bytes:
        if any(s in text for s in self.special):  # they are case-sensitive, and may end in signs
            return b"".join([self._whole(c.decode()) for c in text.split()])
        return b"".join([self._look(c) for c in text.lower().split()])

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, without end ids, and the number of ids of each; a null has none."""
        texts = texts.fill_null("")
        if any(pc.any(pc.match_substring(texts, s.decode())).as_py() for s in self.special):
            found = [self.encode(t.as_py().encode()) for t in texts]
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(f) // 4 for f in found], np.int64)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        chunks = lists.values.dictionary_encode()
        distinct = chunks.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        coded = list(map(self.memo.get, distinct))
        if None in coded:
            coded = [self._look(c) if ids is None else ids for c, ids in zip(distinct, coded)]
        ids = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        which = np.asarray(chunks.indices)
        own = sizes[which]
        ends = np.concatenate([[0], np.cumsum(own)])
        # every chunk copies the run of ids of its distinct chunk
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        return ids[np.repeat(shift, own) + np.arange(ends[-1])], np.diff(ends[np.asarray(lists.offsets)])

    def _look(self, chunk: bytes) -> bytes:
        ids = self.memo.get(chunk)
        if ids is None:
            ids = self._run(chunk.decode()) if chunk.isalpha() else self._learn(chunk)
            if len(self.memo) < MEMO_CHUNKS:
                self.memo[chunk] = ids
        return ids

    def _learn(self, chunk: bytes) -> bytes:
        """Ids of a chunk that is more than lower-case ASCII letters."""
        core, word = chunk.rstrip(_TAIL), chunk.decode()
        if core.isalpha() and core != chunk:
            return self._look(core) + self._look(chunk[len(core) :])
        if not chunk.isascii():
            # a word of Latin letters is one piece, and signs after it are another
            small = word[: len(word) - len(chunk) + len(core)].lower()
            if not _LETTERS.fullmatch(small):
                return self._whole(word)
            ids = self._run("".join([self.alphabet[b] for b in small.encode()]))
            return ids + self._look(chunk[len(core) :]) if core != chunk else ids
        if not word.isprintable():
            return self._whole(word)
        pieces = _PIECES.findall(word)
        return self._run(word) if len(pieces) == 1 else b"".join([self._look(p.encode()) for p in pieces])

    def _run(self, piece: str) -> bytes:
        written = self.written
        return b"".join([written[t.id] for t in self.model.tokenize(piece)])

    def _whole(self, chunk: str) -> bytes:
        return b"".join([self.written[i] for i in self.tokenizer.encode(chunk, add_special_tokens=False).ids])


def document_ids(path: str, text: str | None) -> bytes:
    """Ids of a text (null: none) and the end id, as little-endian 32-bit bytes."""
    return (encoder(path).encode(text.encode()) if text else b"") + END_ID.to_bytes(4, "little")


def _cut(text: bytes) -> Iterator[str]:
    """A long text in pieces that end before white space, so that no chunk is cut."""
    low = 0
    while low < len(text):
        space = _SPACE.search(text, low + _BATCH)
        high = space.start() if space else len(text)
        yield text[low:high].decode()
        low = high


def ids_of_batch(path: str, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``low, high, ids, counts`` for runs of rows of a batch: the ids of all its documents end to end, and the number of each; end ids included."""
    coder = encoder(path)
    offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0), np.int64))])
    for low, high in runs_of_rows(offsets, _BATCH):
        if offsets[high] - offsets[low] > _BATCH:  # one long text
            pieces = [coder.encode_all(pa.array([p], pa.string()))[0] for p in _cut(texts[low].as_py().encode())]
            plain = np.concatenate(pieces)
            counts = np.array([len(plain)])
        else:
            plain, counts = coder.encode_all(texts.slice(low, high - low))
        counts = counts + 1
        ids = np.full(int(counts.sum()), END_ID, "<u4")
        ids[np.arange(len(plain)) + np.repeat(np.arange(high - low), counts - 1)] = plain
        yield low, high, ids, counts
    give_back()


def write_ids(docs: DataFrame, vocabulary: str, name: str = "token-ids") -> DataFrame:
    """Encode ``docs`` in ascending ``doc_id`` order into a stored id file; the file's rows.

    The file is a folder of Parquet parts in document order. A row is one block of
    whole documents, at least ``BLOCK_IDS`` ids unless its part ends:

    ``part, block``  place of the block in the file
    ``doc_ids, ends``  ids of its documents (null ids come first) and the running number of token ids after each
    ``words``  Simple-8b words, little-endian; ``marks``  token ids before every 256th word
    ``n_ids, before``  token ids in the block, and in the part before it
    ``escapes``  ids too wide for any selector, 8 bytes each (none for real vocabularies)

    Every document ends with ``END_ID``; a null or empty text is that id alone. Rows
    with equal ids keep all their texts, in an order that only the texts decide. A text of any length is encoded whole and lies in one
    block. Other columns play no part; an empty table gives no rows.
    """

    def blocks(batches):
        part, ids, ends, chunks, total, number, written = None, [], [], [], 0, 0, 0

        def flush():
            nonlocal number, written
            coded = simple8b.encode(np.concatenate(chunks))
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([coded.words.tobytes()], pa.binary()),
                    pa.array([coded.marks], pa.list_(pa.int64())),
                    pa.array([coded.escapes.tobytes()], pa.binary()),
                    pa.array([total], pa.int64()),
                    pa.array([written], pa.int64()),
                ],
                names=["part", "block", "doc_ids", "ends", "words", "marks", "escapes", "n_ids", "before"],
            )
            number += 1
            written += total
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            docs_ = batch["doc_id"].to_pylist()
            for low, _, found, counts in ids_of_batch(vocabulary, batch["text"]):
                bounds = np.concatenate([[0], np.cumsum(counts)])
                done = 0
                while done < len(counts):
                    # whole documents until the block is full
                    full = int(np.searchsorted(bounds, bounds[done] + BLOCK_IDS - total))
                    upto = min(full, len(counts))
                    chunks.append(found[bounds[done] : bounds[upto]])
                    ids += docs_[low + done : low + upto]
                    ends += (bounds[done + 1 : upto + 1] - bounds[done] + total).tolist()
                    total = ends[-1]
                    done = upto
                    if total >= BLOCK_IDS:
                        yield flush()
                        ids, ends, chunks, total = [], [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the order of rows that share an id; it splits them over tasks only where one id has too many for a task, for then all texts
    # are read once more to find the ranges
    tied = rows.withColumn("tie", F.xxhash64("text"))
    n = parts(docs.sparkSession)
    by = ["doc_id", "tie"] if _crowded(rows, n) else ["doc_id"]
    ordered = (
        tied.repartitionByRange(n, *by)
        .sortWithinPartitions("doc_id", "tie", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    coded = ordered.mapInArrow(
        giving_back(blocks),
        "part int, block int, doc_ids array<long>, ends array<long>, words binary, marks array<long>, escapes binary, n_ids long, before long",
    )
    return stage(coded, name, arrow_rows=_ARROW_ROWS)


def _crowded(rows: DataFrame, n: int) -> bool:
    """Whether a doc_id has more rows than a task's share; only ids are read."""
    found = rows.groupBy("doc_id").count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return (found["most"] or 0) * n > (found["all"] or 0) and found["most"] > 1


def read_ids(file: DataFrame) -> DataFrame:
    """Documents of an id file: ``part, block, row, doc_id, start`` (in the whole file), ``ids`` as little-endian 32-bit bytes."""

    def documents(batch):
        held, filled = [], 0
        part, block, base = (np.asarray(batch[c]) for c in ("part", "block", "base"))
        lists = [(np.asarray(c.values), np.asarray(c.offsets)) for c in (batch["ends"],)]
        docs_, (ends_, offsets) = batch["doc_ids"], lists[0]
        for i in range(batch.num_rows):
            words, escapes = (np.frombuffer(batch[c][i].as_buffer(), "<u8") for c in ("words", "escapes"))
            raw = simple8b.decode(words, escapes).astype("<u4").tobytes()
            ends = ends_[offsets[i] : offsets[i + 1]]
            starts = np.concatenate([[0], ends[:-1]])
            n = len(ends)
            pieces = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
            held.append((np.full(n, part[i]), np.full(n, block[i]), np.arange(n, dtype=np.int32), docs_[i].values, starts + base[i], pieces))
            filled += len(raw)
            if filled > 1 << 22:
                yield _documents(held)
                held, filled = [], 0
        if held:
            yield _documents(held)

    needed = ["part", "block", "doc_ids", "ends", "words", "escapes", "base"]
    return map_arrow(
        _with_base(file).select(needed), documents, "part int, block int, row int, doc_id long, start long, ids binary"
    )


def _documents(held: list[tuple]) -> pa.RecordBatch:
    part, block, row, docs, start, ids = zip(*held)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(part)),
            pa.array(np.concatenate(block)),
            pa.array(np.concatenate(row)),
            pa.concat_arrays(docs),
            pa.array(np.concatenate(start)),
            pa.array([i for ds in ids for i in ds], pa.binary()),
        ],
        names=["part", "block", "row", "doc_id", "start", "ids"],
    )


def _with_base(file: DataFrame) -> DataFrame:
    """Blocks with ``base``, the number of token ids before them; the table of part offsets has a row per writing task."""
    bases = F.broadcast(starts_of_parts(file, "part", "n_ids"))
    return file.join(bases, "part").withColumn("base", F.col("base") + F.col("before"))


def token_file_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the id file of ``docs``, read it back, and describe each document found in it.

    As ``write_ids``: nulls, empty and very long texts, repeated ids and columns of any name are all served; an empty table gives no rows.
    """

    def describe(batch):
        ids = batch["ids"]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["start"],
                pa.array([len(x.as_buffer()) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x.as_buffer()) for x in ids], pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    documents = read_ids(write_ids(docs, vocabulary)).select("doc_id", "start", "ids")
    return map_arrow(documents, describe, "doc_id long, start long, n_tokens long, ids_crc32 long")
