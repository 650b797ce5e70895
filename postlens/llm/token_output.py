"""Token-id output in Simple-8b words, in ascending document order.

Documents are range-partitioned and sorted by id, tokenised a bounded slice at a
time, and written as Parquet shards: a row for each document with its words, the
first word of each block, its place in the shard and the ids before it in the
shard. A document's start in the whole output is its shard's base, a running sum
over one number a shard, plus that.

Texts are encoded as the tokenizer's own plain call does it: the string of one of
its special tokens in a text becomes that token's id.

Edge cases: a null text is encoded as an empty one, so every document has at
least its end id; null ids come first, and documents of equal (or null) id follow
one another by a hash of their texts, which also lets them be dealt over many
shards; a text of any length is one row, encoded in parts of bounded size where it can be cut; an empty table gives
empty output. Only ``doc_id`` and ``text`` are read, so further columns of any
name do no harm.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b, store

#: Bytes of text, and of coded words, that a task works on at a time (a longer document is worked on alone).
SLICE_BYTES = 2 << 20
#: Pieces, and bytes of them, that a worker remembers the ids of.
CACHED, CACHED_BYTES = 200_000, 4 << 20
#: Marks of pieces seen before, by hash: a piece is remembered when it comes again.
SEEN = 1 << 21
#: Pieces to a line that is encoded, and bytes of lines to a call: its results are objects many times their text.
LINE, CALL_BYTES = 1024, 1 << 17
#: Blocks that are decoded at a time.
BLOCKS_AT_ONCE = 1024
SHARD = "doc_id long, shard int, place long, before long, n_tokens long, words binary, block_starts array<int>"
#: Two neighbouring blanks of any kind: there the cut at single spaces could fall inside a pre-token.
_BLANKS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]{2}"
_BLANK = _BLANKS.removesuffix("{2}")
_BLANK_EDGE = f"^{_BLANK}|{_BLANK}$|^$"
_tokenizers: dict[str, object] = {}
_spaced: dict[str, np.ndarray] = {}
_apart: dict[str, bool] = {}
_pieces: dict[str, _Pieces] = {}


def tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of its own only add memory
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _ids_of(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids one behind the other and their counts; CALL_BYTES of text to a call."""
    found: list[np.ndarray] = []
    at, encode = 0, tokenizer(path).encode_batch_fast
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CALL_BYTES):
            size += len(texts[end])
            end += 1
        found += [np.array(e.ids, np.uint32) for e in encode(texts[at:end], add_special_tokens=False)]
        at = end
    return np.concatenate([np.zeros(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))


#: A single blank between two other characters: no piece goes across it, so a text can be cut before it.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _whole_ids(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of texts that are not to be taken apart, except that long ones go to the tokenizer in parts of about CALL_BYTES.

    A run of more characters without a single blank between two others is one part.
    """
    safe = not any(" " in token for token in _added(path))
    parts: list[str] = []
    of_text = np.zeros(len(texts), np.int64)
    for n, text in enumerate(texts):
        at = 0
        while safe and len(text) - at > CALL_BYTES and (m := _CUT.search(text, at + CALL_BYTES)):
            parts.append(text[at : m.start()])
            of_text[n] += 1
            at = m.start()
        parts.append(text[at:])
        of_text[n] += 1
    ids, count = _ids_of(parts, path)
    return ids, np.add.reduceat(count, np.cumsum(of_text) - of_text) if len(texts) else count


def _added(path: str) -> list[str]:
    """The strings that the tokenizer takes out of a text before all else."""
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


def _begins_piece(path: str) -> np.ndarray:
    """For each id whether its token starts with a space."""
    if path not in _spaced:
        vocabulary = tokenizer(path).get_vocab()
        _spaced[path] = flags = np.zeros(max(vocabulary.values()) + 1, bool)
        flags[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
    return _spaced[path]


#: Marks that may follow a word; behind a letter they begin a pre-token. No apostrophe, as contractions begin with one.
_MARKS = np.isin(np.arange(256), list(b".,;:!?&#%$*"))
#: Letters of one or two bytes, by code point; these have been letters in every version of Unicode.
_LETTERS = np.array([chr(x).isalpha() for x in range(0x250)])


def _takes_words_apart(path: str) -> bool:
    """Whether texts are cut into runs of letters, of digits and of marks before all else: byte-level, by its own pattern."""
    if path not in _apart:
        told = json.loads(tokenizer(path).to_str())
        cut = told.get("pre_tokenizer") or {}
        _apart[path] = told.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") is True and not cut.get("add_prefix_space")
    return _apart[path]


def _words_and_rests(pieces: pa.LargeStringArray, path: str) -> pa.LargeStringArray:
    """For each piece its word, and the marks and next line that follow it: cut behind a letter, where no pre-token goes across.

    Else the whole piece and an empty string.
    """
    offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    begin, stop = offsets[:-1], offsets[1:]
    end = stop.copy()
    if len(pieces) and _takes_words_apart(path) and stop[-1]:
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        line = begin[0] + np.flatnonzero(data[begin[0] : stop[-1]] == 10)[::-1]  # a piece's first line end comes last
        end[np.searchsorted(stop, line, side="right")] = line
        live = np.flatnonzero(end > begin)
        while len(live):
            live = live[_MARKS[data[end[live] - 1]]]
            end[live] -= 1
            live = live[end[live] > begin[live]]
        some = np.flatnonzero((end > begin) & (end < stop))
        last, before = data[end[some] - 1].astype(np.int64), data[np.maximum(end[some] - 2, 0)].astype(np.int64)
        point = np.where(last < 128, last, np.where((before >= 0xC3) & (before <= 0xC8), (before - 0xC0) * 64 + last - 128, 0))
        good = np.zeros(len(end), bool)
        good[some[_LETTERS[point]]] = True
        end = np.where(good, end, stop)
    both = np.append(np.column_stack([begin, end]).reshape(-1), offsets[-1:])
    return pa.LargeStringArray.from_buffers(2 * len(pieces), pa.py_buffer(both), pieces.buffers()[2])


class _Pieces:
    """Ids of pieces (without spaces) that each follow a space; the first of a worker are remembered.

    Most are encoded as long lines of pieces; a token that starts with a space
    begins the next piece. Those that a blank begins or ends go one by one.
    """

    def __init__(self, path: str):
        self.path, self.number, self.held = path, {}, 0
        self.seen = np.zeros(SEEN, bool)
        # what is remembered, and behind it the new pieces of the last call, until the next one keeps some of them
        self.ids, self.count, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.n_ids = self.n_pieces = 0
        self.last: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _encode(self, pieces: list[str], alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = list(compress(pieces, (~alone).tolist())) if alone.any() else pieces
        ids, _ = _ids_of([" " + " ".join(joined[k : k + LINE]) for k in range(0, len(joined), LINE)], self.path)
        start = np.flatnonzero(_begins_piece(self.path)[ids])
        if len(start) != len(joined):
            raise ValueError("this tokenizer's pieces don't begin at its tokens with a space")
        if not alone.any():
            return ids, np.diff(np.append(start, len(ids)))
        more, more_count = _ids_of([" " + x for x in compress(pieces, alone.tolist())], self.path)
        # in the order of the pieces, those encoded alone put in between
        count = np.zeros(len(pieces), np.int64)
        count[~alone], count[alone] = np.diff(np.append(start, len(ids))), more_count
        out, is_alone = np.zeros(int(count.sum()), np.uint32), np.repeat(alone, count)
        out[~is_alone], out[is_alone] = ids, more
        return out, count

    def __call__(self, pieces: pa.Array, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and count and first place of each piece; those that are not new to this worker, or ``often`` here, are remembered."""
        self._keep_last()
        listed = pieces.to_numpy(zero_copy_only=False).tolist()  # far quicker than one scalar after another
        known = self.number
        at = np.fromiter(map(known.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(at < 0)
        fresh = list(compress(listed, (at < 0).tolist()))
        alone = pc.match_substring_regex(pieces.take(pa.array(new)), _BLANK_EDGE).to_numpy(zero_copy_only=False)
        ids, count = self._encode(fresh, alone)
        at[new] = self.n_pieces + np.arange(len(new))
        self._append(ids, count, len(ids), len(count))
        upto = self.n_ids + len(ids)
        if len(known) < CACHED and self.held < CACHED_BYTES:
            mark = np.fromiter(map(hash, fresh), np.int64, len(fresh)) & (SEEN - 1)
            keep = often[new] | self.seen[mark]
            self.seen[mark] = True
            kept = list(compress(fresh, keep.tolist()))
            self.held += sum(map(len, kept))
            known.update(zip(kept, range(self.n_pieces, self.n_pieces + len(kept))))
            self.last = ids, count, keep
        return self.ids[:upto], self.count[at], self.begin[at]

    def _append(self, ids: np.ndarray, count: np.ndarray, n_ids: int, n_pieces: int) -> None:
        """Put pieces behind those remembered, in buffers that grow by doubling."""
        for name, used in (("ids", self.n_ids + n_ids), ("count", self.n_pieces + n_pieces), ("begin", self.n_pieces + n_pieces)):
            old = getattr(self, name)
            if used > len(old):
                grown = np.zeros(max(used, 2 * len(old)), old.dtype)
                grown[: len(old)] = old
                setattr(self, name, grown)
        self.ids[self.n_ids : self.n_ids + n_ids] = ids
        self.count[self.n_pieces : self.n_pieces + n_pieces] = count
        self.begin[self.n_pieces : self.n_pieces + n_pieces] = self.n_ids + np.cumsum(count) - count

    def _keep_last(self) -> None:
        if self.last is not None:
            ids, count, keep = self.last
            self.last, kept = None, ids[np.repeat(keep, count)]
            self._append(kept, count[keep], len(kept), int(keep.sum()))
            self.n_ids, self.n_pieces = self.n_ids + len(kept), self.n_pieces + int(keep.sum())


def tokenize(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one behind the other, each text's end id included, and their counts.

    A byte-level BPE vocabulary never joins across a single space between two
    other characters: the text is cut before those, where the tokenizer's own
    pattern allows it also behind words, and each distinct piece is encoded once.
    Texts with neighbouring blanks, or with the string of an added
    token, are encoded whole.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    whole = pc.match_substring_regex(texts, _BLANKS).to_numpy(zero_copy_only=False)
    for token in _added(path):
        whole = whole | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
    per_text = 2 * np.diff(parts.offsets.to_numpy()).astype(np.int64)
    coded = _words_and_rests(parts.flatten(), path).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary
    lead = np.arange(len(index)) % 2 == 0
    lead[np.cumsum(per_text) - per_text] = False  # a text's first piece has no space before it, nor has what follows a word
    times = np.bincount(index[lead], minlength=len(distinct))
    spaced, bare = np.flatnonzero(times), np.flatnonzero(np.bincount(index[~lead], minlength=len(distinct)))
    if path not in _pieces:
        _pieces[path] = _Pieces(path)
    ids, count, begin = _pieces[path](distinct.take(pa.array(spaced)), times[spaced] > 1)
    more, more_count = _ids_of(distinct.take(pa.array(bare)).to_numpy(zero_copy_only=False).tolist(), path)
    begin = np.concatenate([begin, len(ids) + np.cumsum(more_count) - more_count])
    ids, count = np.concatenate([ids, more]), np.concatenate([count, more_count])
    place = np.zeros((2, len(distinct)), np.int64)
    place[0, spaced], place[1, bare] = np.arange(len(spaced)), len(spaced) + np.arange(len(bare))
    index = np.where(lead, place[0, index], place[1, index])
    wholes = np.flatnonzero(whole)
    if len(wholes):  # their pieces follow the distinct ones; such a text is one empty piece so far
        more, more_count = _whole_ids([texts[int(i)].as_py() for i in wholes], path)
        begin = np.concatenate([begin, len(ids) + np.cumsum(more_count) - more_count])
        index[(np.cumsum(per_text) - per_text)[wholes]] = len(count) + np.arange(len(wholes))
        ids, count = np.concatenate([ids, more]), np.concatenate([count, more_count])
    # the end id is a last piece of each text
    ids, begin, count = np.append(ids, np.uint32(end_id)), np.append(begin, len(ids)), np.append(count, 1)
    index = np.insert(index, np.cumsum(per_text), len(count) - 1)
    sizes = count[index]
    out = ids[np.repeat(begin[index] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
    return out, np.add.reduceat(sizes, np.concatenate([[0], np.cumsum(per_text + 1)[:-1]]))


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of the column."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            fits = int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES - size, side="right"))
            if fits or not held:
                held.append(batch.slice(at, max(1, fits)))
                at += max(1, fits)
                size += int(sizes[at - len(held[-1]) : at].sum())
            if at < len(sizes) or size >= SLICE_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, before = TaskContext.get().partitionId(), 0, 0
        for batch in _slices(batches, "text"):
            ids, count = tokenize(batch.column("text"), path, end_id)
            words, per_block, blocks = simple8b.encode(ids.astype(np.uint64), count)
            block_at = np.concatenate([[0], np.cumsum(blocks)])
            word_at = np.concatenate([[0], np.cumsum(per_block)])
            data = words.astype("<u8").tobytes()
            n = len(count)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(place + np.arange(n)),
                    pa.array(before + np.cumsum(count) - count),
                    pa.array(count),
                    pa.array([data[8 * word_at[a] : 8 * word_at[b]] for a, b in zip(block_at, block_at[1:])], pa.binary()),
                    pa.array([(word_at[a:b] - word_at[a]).astype(np.int32) for a, b in zip(block_at, block_at[1:])], pa.list_(pa.int32())),
                ],
                names=["doc_id", "shard", "place", "before", "n_tokens", "words", "block_starts"],
            )
            place, before = place + n, before + int(count.sum())

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the token shards of ``docs`` (``doc_id``, ``text``) to the folder ``path``."""
    store.small_batches(docs.sparkSession)
    order = ["doc_id", F.xxhash64("text")]  # ids alone could not be split where many are equal or null
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ordered.mapInArrow(_encoder(tokenizer_path, end_id), SHARD).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards' rows with ``start``, the ids of all documents before."""
    rows = spark.read.schema(SHARD).parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    base = totals.select("shard", F.coalesce(F.sum("_n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(base), "shard").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, all their ids, and where each row's begin: whole blocks by their offsets, a bounded number at a time."""
    for batch in _slices(batches, "words"):
        count, starts = batch.column("n_tokens").to_numpy(), batch.column("block_starts")
        words = np.frombuffer(b"".join(batch.column("words").to_pylist()), "<u8")
        size = pc.divide(pc.binary_length(batch.column("words")), 8).to_numpy(zero_copy_only=False).astype(np.int64)
        blocks = pc.list_value_length(starts).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = starts.flatten().to_numpy().astype(np.int64) + np.repeat(np.cumsum(size) - size, blocks)
        holds = simple8b.block_sizes(count, blocks)
        parts = [np.zeros(0, np.uint64)]
        for k in range(0, len(begin), BLOCKS_AT_ONCE):
            mine = begin[k : k + BLOCKS_AT_ONCE]
            end = begin[k + BLOCKS_AT_ONCE] if k + BLOCKS_AT_ONCE < len(begin) else len(words)
            parts.append(simple8b.decode_blocks(words[mine[0] : end], mine - mine[0], holds[k : k + BLOCKS_AT_ONCE]).astype(np.uint32))
        yield batch, np.concatenate(parts).astype(np.uint32), np.concatenate([[0], np.cumsum(count)])


_CODED = ["doc_id", "start", "n_tokens", "words", "block_starts"]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the shards."""

    def ids_of(batches):
        for batch, ids, at in _decoded(batches):
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int64)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), lists], names=["doc_id", "start", "n_tokens", "ids"])

    return read_shards(spark, path).select(*_CODED).mapInArrow(ids_of, "doc_id long, start long, n_tokens long, ids array<long>")


def read_spans(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """``doc_id, ids``: the ids number ``low`` to ``high`` (exclusive) of each document, from the blocks that hold them alone."""

    def spans_of(batches):
        for batch in batches:
            rows = []
            for words, starts, count in zip(batch.column("words").to_pylist(), batch.column("block_starts").to_pylist(), batch.column("n_tokens").to_pylist()):
                coded = np.frombuffer(words, "<u8")
                rows.append(simple8b.decode_span(coded, np.array(starts, np.int64), count, low, high).astype(np.int64))
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return spark.read.schema(SHARD).parquet(path).select("doc_id", "n_tokens", "words", "block_starts").mapInArrow(spans_of, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the decoded shards."""

    def digests_of(batches):
        for batch, ids, at in _decoded(batches):
            data = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at, at[1:])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, path).select(*_CODED).mapInArrow(digests_of, "doc_id long, start long, n_tokens long, ids_crc32 long")
