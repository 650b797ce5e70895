"""A hidden Markov language model: trained by Baum-Welch over all partitions, scored by the scaled forward recursion.

A text is its words, in order, and one end. A state emits a class of words, the class a word:
a word that makes up a share of ``1 / FREQUENT`` of the training tokens is a class of its own (there are
no more than FREQUENT of those, whatever the corpus), the others share RARE classes by
hash, and ``P(word | state) = P(class | state) * (c + 0.5) / mass(class)``. So what the states learn is of
bounded size and can be broadcast, while the counts ``c`` of all words, which grow with the
corpus, stay a table. Each rare class has a place for one unknown word, with c = 0.

1. *Encode.* Texts are read once, in blocks of a task: a document's words as numbers of its block's
   words, and the block's words with their counts in training documents.
2. *Count.* Counts meet by word; each block gets its own words' counts back, and its documents become
   class numbers with what does not depend on states (base score, known words, words within their classes).
   So a word that all documents have is a row a block, not a row a document.
3. *Train.* States start from seeded chance around the counts of all training tokens (``Model.new``); each
   Baum-Welch round goes over all training documents: tasks add up expected counts,
   as integers (multiples of 2**-20), which meet by class. The order of tasks changes nothing.
4. *Score.* All documents, by the forward recursion.

Recursions run over pieces of PIECE tokens of all documents of a batch side by side: products of
transfer matrices carry the state over a piece, a short chain joins a document's pieces, then
forward and backward vectors fill them. That is the same likelihood as token by token, scaled as it goes.

Edge cases: a null or empty text is the end alone. A row with a null id is a training row. Rows
that repeat an id are rows of their own. A text of any length is one row: its pieces go in
groups of bounded size. Without training rows all words are unknown and the states equal. An empty table gives an
empty result. Words are told apart by 64-bit hashes: among a billion distinct ones some pair clashes with a chance of 3 %,
and then shares a count. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .words import Hasher, chunks

FREQUENT = 16384
RARE = 1024
STATES = 6
ROUNDS = 6
#: Distinct words and tokens that a block holds at most, but for a single text.
BLOCK_WORDS, BLOCK_TOKENS = 1 << 20, 1 << 22
PIECE = 64
#: Pieces worked on at a time.
PIECES = 8192
RESCALE = 8
UNIT = float(1 << 20)
#: Weight of all training tokens in what a state emits.
PRIOR = 50.0
LOG10 = np.log(10.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document takes no part in training; those without an id do."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


# encode


class _Encoder:
    """A task's open block: documents as hashes by chunk, until a block is full."""

    def __init__(self) -> None:
        self.hasher = Hasher()
        self.begin()

    def begin(self) -> None:
        self.unique: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.docs: list[tuple[np.ndarray, np.ndarray]] = []  # words as numbers of their chunk's; where each text starts
        self.rows: list[pa.RecordBatch] = []
        self.words = self.tokens = 0

    def add(self, batch: pa.RecordBatch) -> Iterator[list[pa.RecordBatch]]:
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for texts in chunks(batch.column("text"), self.hasher):
            unique, number = np.unique(texts.word, return_inverse=True)
            learns = np.repeat(train[texts.rows], np.diff(texts.at))
            self.unique.append(unique)
            self.counts.append(np.bincount(number[learns], minlength=len(unique)))
            self.docs.append((number.astype(np.int32), texts.at))
            self.rows.append(batch.select(["doc_id", "held_out"]).slice(int(texts.rows[0]), len(texts.rows)))
            self.words += len(unique)
            self.tokens += len(number)
            if self.words > BLOCK_WORDS or self.tokens > BLOCK_TOKENS:
                yield self.flush()

    def flush(self) -> tuple[np.ndarray, np.ndarray, list]:
        unique, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.unique]), return_inverse=True)
        count = np.bincount(place, np.concatenate([np.zeros(0), *self.counts]), len(unique)).astype(np.int64)
        out, at = [], 0
        for mine, (number, first), rows in zip(self.unique, self.docs, self.rows):
            out.append((place[at : at + len(mine)][number].astype("<i4"), first, rows))
            at += len(mine)
        self.begin()
        return unique, count, out


ENCODED = "block long, doc_id {id}, held_out boolean, words binary, hash binary, n binary"


def _encode(kind: pa.DataType):
    """Rows of documents (``words``) and, for each block, one of its words (``hash, n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, open_ = TaskContext.get().partitionId(), 0, _Encoder()
        names = ["block", "doc_id", "held_out", "words", "hash", "n"]

        def rows(flushed) -> Iterator[pa.RecordBatch]:
            unique, count, docs = flushed
            name = (task << 32) + block
            none = pa.array([None], pa.binary())
            yield pa.record_batch([pa.array([name]), pa.array([None], kind), pa.array([None], pa.bool_()), none, pa.array([unique.astype("<u8").tobytes()]), pa.array([count.astype("<i8").tobytes()])], names=names)
            for words, first, mine in docs:
                data = words.tobytes()
                texts = pa.array([data[4 * a : 4 * b] for a, b in zip(first, first[1:])], pa.binary())
                empty = pa.nulls(mine.num_rows, pa.binary())
                yield pa.record_batch([pa.array(np.full(mine.num_rows, name)), mine.column("doc_id"), mine.column("held_out"), texts, empty, empty], names=names)

        for batch in batches:
            for flushed in open_.add(batch):
                yield from rows(flushed)
                block += 1
        if open_.rows:
            yield from rows(open_.flush())

    return run


# count


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, hashes, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "hash", "n"))):
            hashes, counts = np.frombuffer(hashes, "<i8"), np.frombuffer(counts, "<i8")
            for a in range(0, len(hashes), 1 << 16):
                n = len(hashes[a : a + (1 << 16)])
                yield pa.record_batch([pa.array(np.full(n, block)), pa.array(hashes[a : a + n]), pa.array(counts[a : a + n])], names=["block", "hash", "n"])


@dataclass
class Classes:
    """Classes of words: hashes of frequent ones in rising order, then RARE classes, then the end.

    mass: training tokens and half a token a word in each class; tokens: all training tokens; known: distinct ones.
    """

    frequent: np.ndarray
    mass: np.ndarray
    tokens: int
    known: int
    ends: int

    def end(self) -> int:
        return len(self.mass) - 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return (hashes.view(np.uint64) % RARE).astype(np.int64)
        at = np.searchsorted(self.frequent, hashes)
        at[at == len(self.frequent)] = 0
        return np.where(self.frequent[at] == hashes, at, len(self.frequent) + (hashes.view(np.uint64) % RARE).astype(np.int64))


def classes_of(counts: DataFrame, ends: int) -> Classes:
    """counts: ``hash, c`` of all words; ends: training documents."""
    known = F.col("c") > 0
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(known)).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    often = known & (F.col("c") * FREQUENT >= tokens)
    frequent = counts.where(often).select("hash", "c").orderBy("hash").toArrow()  # FREQUENT rows at most
    bucket = F.pmod("hash", F.lit(RARE)).cast("int")  # 2**64 is a multiple of RARE: the sign of the long makes no difference
    rare = counts.where(known & ~often).groupBy(bucket.alias("k")).agg(F.sum(F.col("c") + 0.5).alias("mass")).collect()
    mass = np.full(frequent.num_rows + RARE + 1, 0.5)
    mass[: frequent.num_rows] += frequent.column("c").to_numpy()
    for r in rare:
        mass[frequent.num_rows + r.k] += r.mass
    mass[-1] += ends
    return Classes(frequent.column("hash").to_numpy().astype(np.int64), mass, tokens, distinct, ends)


CODED = "doc_id {id}, held_out boolean, n_tokens long, n_known long, base double, inside double, classes binary"


def _coder(classes: Classes):
    """A block's words with their counts, and its documents: class numbers and what the states don't change."""
    log_all = np.log10(classes.tokens + 0.5 * (classes.known + 1))
    log_mass = np.log10(classes.mass)
    end_known, end_base = classes.ends > 0, np.log10(classes.ends + 0.5) - log_all

    def run(words: pa.Table, docs: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
        order = np.argsort(words.column("hash").to_numpy().view(np.uint64))  # the block's own order
        hashes, counts = words.column("hash").to_numpy()[order], words.column("c").to_numpy()[order]
        kind = classes.of(hashes)
        known, log = counts > 0, np.log10(counts + 0.5)
        inside = log - log_mass[kind]
        out = []
        for batch in docs.to_batches(max_chunksize=512):
            ids = [np.frombuffer(x, "<i4") for x in batch.column("words").to_pylist()]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            token = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
            text = np.repeat(np.arange(len(ids)), n)
            total = lambda x: np.bincount(text, x[token], len(ids)).astype(float)  # noqa: E731, B023
            named = kind[token].astype("<u2").tobytes() if len(token) else b""
            at = np.concatenate([[0], np.cumsum(n)])
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id"),
                        "held_out": batch.column("held_out"),
                        "n_tokens": pa.array(n + 1),
                        "n_known": pa.array(total(known.astype(float)).astype(np.int64) + end_known),
                        "base": pa.array(total(log) - n * log_all + end_base),
                        "inside": pa.array(total(inside)),
                        "classes": pa.array([named[2 * a : 2 * b] for a, b in zip(at, at[1:])], pa.binary()),
                    }
                )
            )
        return pa.concat_tables(out) if out else None

    return run


def _cogrouped(classes: Classes, kind: pa.DataType):
    code = _coder(classes)

    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        names = {"doc_id": kind, "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "inside": pa.float64(), "classes": pa.binary()}
        found = code(words, docs)
        return pa.table({n: pa.array([], t) for n, t in names.items()}) if found is None else found

    return run


# the model


@dataclass
class Model:
    """start[s]; move[s, t]; emit[class, s]: logarithms of none, all rows of start and move and columns of emit add up to one."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def new(mass: np.ndarray, states: int, seed: int = 5) -> Model:
        """States that differ by chance and last."""
        r = np.random.default_rng(seed)
        base = mass / mass.sum()
        emit = base[:, None] * r.gamma(2.0, 0.5, (len(mass), states))
        emit[-1] = base[-1]
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(0))

    def updated(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, mass: np.ndarray) -> Model:
        """From expected counts, each with a little of what is known without states."""
        states = len(self.start)
        base = mass / mass.sum()
        start, move = start + 1.0, move + 1.0
        emit = emit + PRIOR * base[:, None]
        if states == 1:
            emit = mass[:, None].copy()
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Pieces:
    """Documents' tokens in pieces of PIECE, longest first: what the recursions run over."""

    def __init__(self, token: np.ndarray, n: np.ndarray):
        """token: classes of all documents, ends included; n: tokens of each document (at least one)."""
        per = -(-n // PIECE)
        first = np.concatenate([[0], np.cumsum(per)])
        doc = np.repeat(np.arange(len(n)), per)
        nth = np.arange(len(doc)) - first[doc]
        self.start = (np.cumsum(n) - n)[doc] + nth * PIECE
        self.size = np.minimum(PIECE, n[doc] - nth * PIECE)
        self.last = nth == per[doc] - 1
        self.token, self.per, self.first = token, per, first

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Piece numbers, longest first, their classes (place by piece) and how many pieces reach each place."""
        for a in range(0, len(self.size), PIECES):
            b = min(len(self.size), a + PIECES)
            order = a + np.argsort(-self.size[a:b], kind="stable")
            place = np.minimum(np.arange(PIECE)[:, None], self.size[order][None, :] - 1)
            active = (self.size[order][None, :] > np.arange(PIECE)[:, None]).sum(1)
            yield order, self.token[self.start[order][None, :] + place], active


def _scaled(x: np.ndarray, log: np.ndarray, axes) -> None:
    """Divide each by its greatest entry, in place, and add its logarithm."""
    most = x.max(axis=axes)
    x /= most.reshape(most.shape + (1,) * (x.ndim - most.ndim))
    log += np.log(most)


class Recursion:
    """Forward and backward over one batch of documents."""

    def __init__(self, model: Model, pieces: Pieces):
        self.model, self.pieces = model, pieces
        most = model.emit.max(1)
        self.emit, self.most = model.emit / most[:, None], np.log(most)
        states, count = len(model.start), len(pieces.size)
        self.carry = np.empty((count, states, states))
        log = np.zeros(count)
        for order, token, active in pieces.groups():
            m = np.broadcast_to(np.eye(states), (len(order), states, states)).copy()
            scale = np.zeros(len(order))
            for t in range(PIECE):
                k = active[t]
                if not k:
                    break
                m[:k] = ((m[:k] * self.emit[token[t, :k]][:, None, :]).reshape(-1, states) @ model.move).reshape(k, states, states)
                if t % RESCALE == RESCALE - 1:
                    _scaled(m, scale, (1, 2))
            _scaled(m, scale, (1, 2))
            self.carry[order], log[order] = m, scale
        # along each document's pieces
        docs = len(pieces.per)
        self.into = np.empty((count, states))
        u, self.log = np.broadcast_to(model.start, (docs, states)).copy(), np.zeros(docs)
        by_length = np.argsort(-pieces.per, kind="stable")
        self.by_length, self.reach = by_length, None
        u = u[by_length]
        sums = np.zeros(docs)
        ordered = pieces.per[by_length]
        for nth in range(int(ordered.max(initial=0))):
            k = int(np.searchsorted(-ordered, -nth, side="left"))
            at = pieces.first[by_length[:k]] + nth
            self.into[at] = u[:k]
            u[:k] = np.einsum("ds,dst->dt", u[:k], self.carry[at])
            total = u[:k].sum(1)
            u[:k] /= total[:, None]
            sums[:k] += np.log(total) + log[at]
        each = np.add.reduceat(self.most[pieces.token], np.concatenate([[0], np.cumsum(self._tokens())[:-1]])) if docs else np.zeros(0)
        self.log[by_length] = sums
        self.log += each

    def _tokens(self) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.pieces.per)), self.pieces.per), self.pieces.size, len(self.pieces.per)).astype(np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions, in multiples of 1 / UNIT."""
        model, pieces = self.model, self.pieces
        states, docs = len(model.start), len(pieces.per)
        after = np.ones((len(pieces.size), states))
        w = np.ones((docs, states))
        ordered = pieces.per[self.by_length]
        for nth in range(int(ordered.max(initial=0)) - 1, -1, -1):
            k = int(np.searchsorted(-ordered, -nth, side="left"))
            at = pieces.first[self.by_length[:k]] + nth
            after[at] = w[:k]
            w[:k] = np.einsum("dst,dt->ds", self.carry[at], w[:k])
            w[:k] /= w[:k].max(1)[:, None]
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape)
        first = np.zeros(len(pieces.size), bool)
        first[pieces.first[:-1]] = True
        for order, token, active in pieces.groups():
            u, kept = self.into[order].copy(), []
            for t in range(PIECE):
                k = active[t]
                if not k:
                    break
                kept.append(u[:k].copy())
                u[:k] = (u[:k] * self.emit[token[t, :k]]) @ model.move
                if t % RESCALE == RESCALE - 1:
                    u /= u.max(1)[:, None]
            w, last, size = after[order], pieces.last[order], pieces.size[order]
            for t in range(len(kept) - 1, -1, -1):
                k = active[t]
                e, aw = self.emit[token[t, :k]], w[:k] @ model.move.T
                before = kept[t] * e
                seen = before * aw
                norm = seen.sum(1)
                seen /= norm[:, None]
                units = np.rint(seen * UNIT)
                for s in range(states):
                    emit[:, s] += np.bincount(token[t, :k], units[:, s], len(emit))
                goes = ~(last[:k] & (size[:k] == t + 1))  # the end goes nowhere
                move += np.rint(((before[goes] / norm[goes, None]).T @ w[:k][goes]) * model.move * UNIT)
                if t == 0:
                    start += units[first[order][:k]].sum(0)
                w[:k] = e * aw
                if t % RESCALE == 0:
                    w /= w.max(1)[:, None]
        return start, move, emit


def _batches(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[pa.RecordBatch, Pieces]]:
    """Some documents at a time: at most half a million tokens, but for one longer text."""
    for batch in batches:
        texts = batch.column("classes").to_pylist()
        n = np.fromiter((len(x) // 2 for x in texts), np.int64, len(texts)) + 1
        a = 0
        while a < len(n):
            b = max(a + 1, a + int(np.searchsorted(np.cumsum(n[a:]), 1 << 19, side="right")))
            token = np.empty(int(n[a:b].sum()), np.int64)
            at = np.cumsum(n[a:b]) - 1
            inner = np.ones(len(token), bool)
            inner[at] = False
            token[at], token[inner] = end, np.frombuffer(b"".join(texts[a:b]), "<u2")
            yield batch.slice(a, b - a), Pieces(token, n[a:b])
            a = b


def _expect(shared):
    """A task's expected counts: a row a class (from 0), the start (-1) and each state left (-2, -3, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        states = len(model.start)
        total = np.zeros((len(model.emit) + 1 + states, states))
        for _, pieces in _batches(batches, len(model.emit) - 1):
            start, move, emit = Recursion(model, pieces).counts()
            total += np.concatenate([emit, start[None], move])
        name = np.concatenate([np.arange(len(model.emit)), -1 - np.arange(1 + states)])
        some = total.any(1)
        if some.any():
            yield pa.record_batch([pa.array(name[some], pa.int32()), *(pa.array(total[some, s].astype(np.int64)) for s in range(states))], names=["row", *(f"s{s}" for s in range(states))])

    return run


def trained(coded: DataFrame, classes: Classes, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """coded: training documents (``classes``)."""
    spark = coded.sparkSession
    size = len(classes.mass)
    model = Model.new(classes.mass, states)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        columns = ", ".join(f"s{s} long" for s in range(states))
        found = coded.select("classes").mapInArrow(_expect(shared), f"row int, {columns}").groupBy("row").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(states)]).toArrow()
        shared.destroy()
        total = np.zeros((size + 1 + states, states))
        row = found.column("row").to_numpy().astype(np.int64)
        total[np.where(row >= 0, row, size - 1 - row)] = np.stack([found.column(f"s{s}").to_numpy() for s in range(states)], 1) / UNIT
        model = model.updated(total[size], total[size + 1 :], total[:size], classes.mass)
    return model


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for rows, pieces in _batches(batches, len(model.emit) - 1):
            score = Recursion(model, pieces).log / LOG10 + rows.column("inside").to_numpy()
            yield pa.record_batch([*(rows.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base")), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def coded(docs: DataFrame) -> tuple[DataFrame, Classes]:
    """All documents as classes (a working table), and the classes."""
    spark = docs.sparkSession
    store.small_batches(spark)
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    name = dict(rows.dtypes)["doc_id"]
    kind = spark.createDataFrame([], rows.select("doc_id").schema).toArrow().schema.field(0).type
    encoded = store.table(rows.mapInArrow(_encode(kind), ENCODED.format(id=name)), "encoded")
    # unpacked anew where it is read: the packed form is the smaller one to keep
    of_blocks = lambda df: df.where("hash IS NOT NULL").select("block", "hash", "n").mapInArrow(_words, "block long, hash long, n long")
    ends = encoded.where("words IS NOT NULL AND NOT held_out").count()
    counts = store.table(of_blocks(encoded).groupBy("hash").agg(F.sum("n").alias("c")), "counts")
    classes = classes_of(counts, ends)
    back = of_blocks(store.again(encoded)).select("block", "hash").join(counts, "hash").select("block", "hash", "c")
    texts = store.again(encoded).where("words IS NOT NULL").select("block", "doc_id", "held_out", "words")
    found = back.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(_cogrouped(classes, kind), CODED.format(id=name))
    out = store.table(found, "coded")
    store.drop(spark, encoded, counts)
    return out, classes


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: logarithms to base 10."""
    rows, classes = coded(docs)
    model = trained(rows.where("NOT held_out"), classes, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = dict(rows.dtypes)["doc_id"]
    found = rows.mapInArrow(_scorer(shared), f"doc_id {name}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(classes.tokens).cast("long").alias("train_tokens"), "base_score", "score")
