"""Language identification with error-correcting output codes.

Each language gets a codeword of bits; a binary classifier for each bit predicts
it from hashed byte n-grams, and the codeword nearest to the predictions, by a
loss weighted with each classifier's reliability, names the language. A bit that
is wrong costs less than the distance between codewords.

Training counts n-grams by language over all labelled documents, summed in the
tasks first; what reaches the driver is one table of ``DIMENSIONS`` counts for
each of ``MAX_LANGUAGES`` languages at most (more are an error). A bit's
classifier is the log-odds of the n-grams in the languages whose codewords have
the bit against those of the others.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a null
language or id takes no part in training; without any labelled document all is
``und``; rows that repeat are predicted alike; equal losses go to the language
first in code-point order. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

DIMENSIONS = 1 << 14
ORDERS = (1, 2, 3)
#: Bounds the model, and what reaches the driver, at DIMENSIONS counts each.
MAX_LANGUAGES = 256
CHUNK_BYTES = 1 << 20
_LETTER = regex.compile(r"\p{L}")
#: Bytes that stand for themselves: ASCII letters, lower-cased, and all of a longer UTF-8 sequence; others are a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def codewords(count: int) -> np.ndarray:
    """A row of -1 and 1 for each language.

    Up to five languages get the exhaustive code (every way to split them); more
    get the best of 200 seeded random codes by least distance between rows.
    """
    if count == 1:
        return np.ones((1, 1))
    if count <= 5:
        bits = (np.arange(1, 1 << (count - 1))[None, :] >> np.arange(count - 1)[:, None]) & 1
        return np.vstack([np.ones(bits.shape[1]), 1 - 2 * bits])
    length, random = int(max(15, np.ceil(10 * np.log2(count)))), np.random.default_rng(7)
    best, far = None, -1
    for _ in range(200):
        code = random.choice([-1.0, 1.0], (count, length))
        code[:, np.abs(code.sum(0)) == count] *= np.where(np.arange(count) % 2, 1, -1)[:, None]  # no bit is the same for all
        near = ((length - code @ code.T) / 2 + length * np.eye(count)).min()
        if near > far:
            best, far = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # DIMENSIONS x bits
    reliability: np.ndarray
    scale: np.ndarray


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Rows, folded bytes, starts of the texts (and the end), and how many bytes n-grams begin at, CHUNK_BYTES at a time.

    A longer text comes in pieces; each but the last ends with the bytes that n-grams of the piece reach into.
    """
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        if offsets[j] - offsets[i] <= CHUNK_BYTES:
            yield np.arange(i, j), _FOLD[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i], CHUNK_BYTES
        else:
            for a in range(int(offsets[i]), int(offsets[j]), CHUNK_BYTES):
                b = min(a + CHUNK_BYTES + max(ORDERS) - 1, int(offsets[j]))
                yield np.arange(i, j), _FOLD[data[a:b]], np.array([0, b - a]), CHUNK_BYTES
        i = j


def _grams(data: np.ndarray, first: np.ndarray, begins: int) -> Iterator[np.ndarray]:
    """For each order the hash of the n-gram at each byte; -1 where it would leave its text, begins with a blank, or behind ``begins``."""
    end = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(data))
    for order in ORDERS:
        code = np.zeros(len(data), np.uint32)
        for k in range(order):
            code[: len(data) - k] = code[: len(data) - k] * np.uint32(257) + data[k:] + np.uint32(1)
        code = (code * np.uint32(2654435761) + np.uint32(order * 40503)) >> np.uint32(18)
        yield np.where((at + order <= end) & (data != 32) & (at < begins), code.astype(np.int32), -1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n-grams by language over a task's rows."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        for rows, data, first, begins in _texts(batch, "text"):
            names = sorted({languages[r] for r in rows})
            number = np.array([names.index(languages[r]) for r in rows])
            owner = np.repeat(number, np.diff(first))
            for gram in _grams(data, first, begins):
                seen = gram >= 0
                found = np.bincount(owner[seen] * DIMENSIONS + gram[seen], minlength=len(names) * DIMENSIONS).reshape(-1, DIMENSIONS)
                for name, counts in zip(names, found):
                    sums[name] = sums.get(name, 0) + counts
    for name, counts in sums.items():
        gram = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([name] * len(gram), pa.string()), pa.array(gram.astype(np.int32)), pa.array(counts[gram].astype(np.int64))], names=["lang", "gram", "n"])


def train(labelled: DataFrame) -> Model | None:
    """labelled: ``text, lang``; all rows count. None without any."""
    store.small_batches(labelled.sparkSession)
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text").mapInArrow(_count, "lang string, gram int, n long")
    sums = store.table(rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    if sums.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would not fit the driver")
    found = sums.toArrow().to_pydict()
    languages = sorted(set(found["lang"]))
    if not languages:
        return None
    counts = np.zeros((len(languages), DIMENSIONS))
    number = {x: i for i, x in enumerate(languages)}
    counts[[number[x] for x in found["lang"]], found["gram"]] = found["n"]
    share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)  # each language counts alike, whatever its amount
    code = codewords(len(languages))
    weights = np.zeros((DIMENSIONS, code.shape[1]))
    for bit in range(code.shape[1]):
        ones, others = code[:, bit] > 0, code[:, bit] < 0
        if ones.any() and others.any():
            weights[:, bit] = np.log(share[ones].mean(0)) - np.log(share[others].mean(0))
    expected = share @ weights  # the mean log-odds of each language's own text
    right = np.where(code > 0, expected, -expected)
    reliability = np.maximum(1e-3, right.min(0))
    return Model(languages, code, weights.astype(np.float32), reliability / reliability.sum(), np.maximum(1e-6, np.abs(expected).mean(0)))


def _predict(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            name, score, gap = np.full(n, "und", object), np.zeros(n), np.zeros(n)
            texts = batch.column("text")
            if model and n:
                padded = np.vstack([model.weights, np.zeros((1, model.weights.shape[1]), np.float32)])  # -1: nothing
                total, seen = np.zeros((n, model.code.shape[1])), np.zeros(n)
                for rows, data, first, begins in _texts(batch, "text"):
                    some = np.flatnonzero(np.diff(first))
                    if not len(some):
                        continue
                    for gram in _grams(data, first, begins):
                        # sums between starts that rise strictly
                        total[rows[some]] += np.add.reduceat(padded[gram], first[some], axis=0)
                        seen[rows[some]] += np.add.reduceat((gram >= 0).astype(np.int64), first[some])
                margin = np.tanh(total / np.maximum(1, seen)[:, None] / model.scale)
                loss = ((1 - model.code[None, :, :] * margin[:, None, :]) / 2 * model.reliability).sum(2)
                order = np.argsort(loss, 1, kind="stable")
                best = order[:, 0]
                for i in np.flatnonzero(seen):
                    if _LETTER.search(texts[int(i)].as_py()):
                        name[i], score[i] = model.languages[best[i]], min(1.0, max(0.0, 1 - loss[i, best[i]]))
                        gap[i] = loss[i, order[i, 1]] - loss[i, best[i]] if len(model.languages) > 1 else 1.0
            yield pa.record_batch([*[batch.column(k) for k in range(batch.num_columns - 1)], pa.array(name, pa.string()), pa.array(score), pa.array(gap)], names=[*batch.schema.names[:-1], "lang_pred", "score", "gap"])

    return predict


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of documents that training leaves out; rows without id are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model | None, ambiguous_below: float = 0.02) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, gap, ambiguous`` for each row of ``docs``.

    score: 1 less the loss of the nearest codeword; gap: by how much the second
    is farther; a gap under ``ambiguous_below`` is flagged.
    """
    store.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    found = rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, gap double")
    return found.withColumn("ambiguous", (F.col("lang_pred") != "und") & (F.col("gap") < ambiguous_below))


def keep_identified(docs: DataFrame, model: Model | None, ambiguous_below: float = 0.02) -> DataFrame:
    """The rows of ``docs`` whose language could be told: neither ``und`` nor ambiguous. All columns stay."""
    store.small_batches(docs.sparkSession)
    predict = _predict(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (found,) = predict(iter([pa.record_batch([batch.column("text")], names=["text"])]))
            named = found.column("lang_pred").to_numpy(zero_copy_only=False) != "und"
            yield batch.filter(pa.array(named & (found.column("gap").to_numpy() >= ambiguous_below)))

    return docs.mapInArrow(keep, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Text and language of the documents that are not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang")
