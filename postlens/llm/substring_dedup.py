"""Exact removal of repeated word windows, by level-wise doubling.

A window is ``window`` consecutive words. At each level (a quarter of the
window, half of it, the window itself) a window stands for the least hash among
its runs of that many words, its anchor: equal windows have equal anchors, and
neighbours mostly share one, so few hashes a document are sent. Windows whose
anchor no other document has end there; the rest alone are looked at again with
runs of twice the length. At the last level the run is the window, and the
documents that have an earlier holder of it are told so.

Hashes go to hash buckets in compact blobs. A task first settles what it can by
itself and sends at most one entry of a hash, so however often a window occurs,
its bucket sees it once a task. Windows count as equal when their 64-bit hashes are:
with n candidate windows, n * n / 2**65 pairs are expected to be equal by
chance. Texts of one word sequence are worked on once:
every later copy is removed whole.

Edge cases: a null text has no words; texts shorter than a window keep all
words; windows that repeat inside a document keep their first occurrence; rows of one
doc_id stand side by side, neither being earlier than the other; null ids come
after all others, side by side too. Rows are told apart by id and a hash of their
text, so those of one id, or of none, are as many keys as they have texts. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read, whatever other
columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed, store
from .words import Hasher, Texts, chunks

FLUSH = 1_000_000
#: Bits of the anchors' hashes that are sent; the windows' own are sent whole.
HASH_BITS = 48
LAST = (1 << 63) - 1
#: Entries that a hash bucket is meant for (it is in memory as a whole), and bytes of text to an entry: every eighth word or so is an anchor.
BUCKET_ENTRIES, ENTRY_BYTES = 2_000_000, 40
#: Rows of a level: entries to compare, the same of keys that their task has seen twice, a flush's documents, an answer that the task has,
#: entries that share the answer to another of the same key and doc_id, a document, a bucket's answer.
ENTRIES, REPEATED, DOCUMENTS, ANSWER, TIED, PROFILE, TOLD = range(7)
DEALT = "kind int, bucket int, flush long, blob binary, doc long, mark long, n_words long, fp long, check long"
_TYPES = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("flush", pa.int64()), ("blob", pa.binary()), ("doc", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("fp", pa.int64()), ("check", pa.int64())])


def levels(window: int) -> tuple[int, ...]:
    """Run lengths, each twice the one before, up to the window."""
    if window % 4:
        raise ValueError("the window must be a multiple of four words")
    return window // 4, window // 2, window


def anchors(word: np.ndarray, hasher: Hasher, run: int, window: int) -> np.ndarray:
    """For each place the least hash among the runs of the window that starts there.

    All 64 bits for the window itself, which decides; 48 for shorter runs, which
    only choose what is looked at again.
    """
    least = hasher.runs(word, run) >> np.uint64(0 if run == window else 64 - HASH_BITS)
    want, have = window - run + 1, 1
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        have += step
    return least


def _places(t: Texts, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and the number of the text of each."""
    many = np.maximum(0, np.diff(t.at) - window + 1)
    owner = np.repeat(np.arange(len(many)), many)
    return np.repeat(t.at[:-1] - (np.cumsum(many) - many), many) + np.arange(len(owner)), owner


def _distinct(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(key):
        step = np.ones(len(key), bool)
        step[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        owner, key = owner[step], key[step]
        order = np.lexsort((key, owner))
        owner, key = owner[order], key[order]
        step = np.ones(len(key), bool)
        step[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        owner, key = owner[step], key[step]
    return owner, key


def _lists(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each owner that there is, and its keys; owners are in order."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    return owner[first], pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array(key.astype(np.int64)))


class _Sender:
    """Holds (document, key) entries of a task and sends them, settling what is repeated here."""

    def __init__(self, buckets: int, last: bool, flush: int | None = None):
        self.buckets, self.last = buckets, last
        self.flush = TaskContext.get().partitionId() << 24 if flush is None else flush
        self.who, self.mark, self.owner, self.key, self.docs, self.held = [], [], [], [], 0, 0

    def add(self, who: np.ndarray, mark: np.ndarray, owner: np.ndarray, key: np.ndarray) -> bool:
        self.who.append(who)
        self.mark.append(mark)
        self.owner.append(owner + self.docs)
        self.key.append(key)
        self.docs += len(who)
        self.held += len(key)
        return self.held >= FLUSH

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        flush, who, mark = self.flush, np.concatenate(self.who), np.concatenate(self.mark)
        owner, key = np.concatenate(self.owner), np.concatenate(self.key)
        self.__init__(self.buckets, self.last, flush + 1)
        order = np.lexsort((who[owner], key))
        owner, key = owner[order], key[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        begin, number = np.flatnonzero(first), np.cumsum(first) - 1
        repeated = (np.diff(np.append(begin, len(key))) > 1)[number]
        later = who[owner] > who[owner][begin][number]
        settled = later if self.last else repeated
        tied = ~(later | first) if self.last else np.zeros(len(key), bool)
        rows = [(DOCUMENTS, None, who.astype("<i8").tobytes() + mark.astype("<i8").tobytes()), (TIED, None, packed.pack_answer(key[tied], owner[tied])), (ANSWER, None, packed.pack_answer(key[settled], owner[settled]))]
        for kind, flag in ((ENTRIES, False), (REPEATED, True)):
            sent = first & (repeated == flag)
            rows += [(kind, b, blob) for b, blob in packed.pack_keys(key[sent], owner[sent], who[owner[sent]] if self.last else None, self.buckets, _bits(self.last))]
        n = len(rows)
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([flush] * n, pa.int64()), pa.array([r[2] for r in rows], pa.binary()), *[pa.nulls(n, pa.int64())] * 5], schema=_TYPES)


def _bits(last: bool) -> int:
    return 64 if last else HASH_BITS


def _first_level(window: int, buckets: int, seed: int):
    """Sends the first level's anchors, and a row for each document."""
    run = levels(window)[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sender, seen = Hasher(seed, lower=False), _Sender(buckets, last=False), {}
        for batch in batches:
            docs, marks = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            for t in chunks(batch.column("text"), hasher):
                who, mark = docs[t.rows].copy(), marks[t.rows].copy()
                fp, check = (hasher.whole(t.word, t.at, salt).view(np.int64) for salt in (1, 2))
                n = len(who)
                yield pa.record_batch([pa.array(np.full(n, PROFILE, np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(docs[t.rows]), pa.array(marks[t.rows]), pa.array(np.diff(t.at)), pa.array(fp), pa.array(check)], schema=_TYPES)
                new = np.ones(n, bool)
                for i, x in enumerate(fp.tolist()):  # copies of one flush are one entry, of their least document; rows of one id stay apart
                    held, held_mark, k = seen.setdefault(x, (who, mark, i))
                    if (held is not who or k != i) and (held[k] != who[i] or held_mark[k] == mark[i]):
                        new[i] = False
                        if who[i] < held[k]:
                            held[k], held_mark[k] = who[i], mark[i]
                place, owner = _places(t, window)
                place, owner = place[new[owner]], owner[new[owner]]
                if sender.add(who, mark, *_distinct(owner, anchors(t.word, hasher, run, window)[place])):
                    yield from sender.send()
                    seen = {}
        yield from sender.send()

    return deal


def _next_level(window: int, level: int, buckets: int, seed: int):
    """The same for windows whose anchor of the level before is among the document's ``keys``."""
    runs = levels(window)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sender = Hasher(seed, lower=False), _Sender(buckets, last=level == len(runs) - 1)
        for batch in batches:
            docs, marks, kept = batch.column("doc").to_numpy(), batch.column("mark").to_numpy(), batch.column("keys")
            for t in chunks(batch.column("text"), hasher):
                place, owner = _places(t, window)
                open_ = _member(anchors(t.word, hasher, runs[level - 1], window)[place], owner, kept.slice(int(t.rows[0]), len(t.rows)))
                place, owner = place[open_], owner[open_]
                if sender.add(docs[t.rows], marks[t.rows], *_distinct(owner, anchors(t.word, hasher, runs[level], window)[place])):
                    yield from sender.send()
        yield from sender.send()

    return deal


def _member(key: np.ndarray, owner: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each key is in the list of its owner; owners are in order."""
    out = np.zeros(len(key), bool)
    if not len(key):
        return out
    values, offset = lists.values.to_numpy().astype(np.uint64), lists.offsets.to_numpy()
    bound = np.searchsorted(owner, np.arange(len(lists) + 1))
    for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)):
        if bound[i] < bound[i + 1] and offset[i] < offset[i + 1]:
            out[bound[i] : bound[i + 1]] = np.isin(key[bound[i] : bound[i + 1]], values[offset[i] : offset[i + 1]])
    return out


def _settle(last: bool, buckets: int):
    """In a bucket: which documents' keys are repeated (last: held by a smaller document too)."""

    def settle(group: pa.Table) -> pa.Table:
        flush, known = group.column("flush").to_numpy(), group.column("kind").to_numpy() == REPEATED
        key, entry, doc, part = packed.unpack_keys(group.column("blob").to_pylist(), group.column("bucket")[0].as_py(), buckets, _bits(last))
        order = np.lexsort((doc, key))
        key, entry, doc, part = key[order], entry[order], doc[order], part[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        begin, number = np.flatnonzero(first), np.cumsum(first) - 1
        if last:
            found = doc > doc[begin][number]
        else:  # of what it has seen twice a task has told its documents already
            times = np.diff(np.append(begin, len(key)))
            found = ((times > 1) | np.logical_or.reduceat(known[part], begin))[number] & ~known[part]
        key, entry, part = key[found], entry[found], part[found]
        by_part = np.argsort(part, kind="stable")
        parts, at = np.unique(part[by_part], return_index=True)
        answers = [packed.pack_answer(key[x], entry[x]) for x in np.split(by_part, at[1:])] if len(parts) else []
        return pa.table({"flush": flush[parts], "kind": np.full(len(parts), TOLD, np.int32), "blob": pa.array(answers, pa.binary())})

    return settle


def _answers(group: pa.Table) -> pa.Table:
    """A flush's documents with their keys."""
    kind = group.column("kind").to_numpy()
    of = lambda k: group.column("blob").filter(pa.array(kind == k)).to_pylist()
    who, mark = np.frombuffer(of(DOCUMENTS)[0], "<i8").reshape(2, -1)
    key, entry = packed.unpack_answers(of(ANSWER) + of(TOLD))
    tied, with_ = packed.unpack_answers(of(TIED))
    also = np.isin(tied, packed.unpack_answers(of(TOLD))[0]) if len(tied) else np.zeros(0, bool)
    owner, key = np.concatenate([entry, with_[also]]), np.concatenate([key, tied[also]])
    order = np.argsort(owner, kind="stable")
    owner, keys = _lists(*_distinct(owner[order], key[order]))
    return pa.table({"doc": who[owner], "mark": mark[owner], "keys": keys})


def _survivors(dealt: DataFrame, last: bool, buckets: int) -> DataFrame:
    """``doc, mark, keys``, a row a document of each flush."""
    entries = dealt.where(F.col("kind").isin(ENTRIES, REPEATED)).select("bucket", "flush", "kind", "blob")
    told = entries.groupBy("bucket").applyInArrow(_settle(last, buckets), "flush long, kind int, blob binary")
    rows = told.union(dealt.where(F.col("kind").isin(DOCUMENTS, ANSWER, TIED)).select("flush", "kind", "blob"))
    return rows.groupBy("flush").applyInArrow(_answers, "doc long, mark long, keys array<long>")


def _finish(window: int, seed: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed, lower=False)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for t in chunks(batch.column("text"), hasher):
                a, n = int(t.rows[0]), len(t.rows)
                place, owner = _places(t, window)
                key = hasher.runs(t.word, window)[place] if len(place) else np.zeros(0, np.uint64)
                gone = _member(key, owner, batch.column("keys").slice(a, n))
                order = np.lexsort((place, key, owner))
                again = np.zeros(len(key), bool)
                again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
                cover = np.zeros(len(t.word) + 1, np.int64)
                np.add.at(cover, place[gone | again], 1)
                np.add.at(cover, place[gone | again] + window, -1)
                drop = np.cumsum(cover)[:-1] > 0
                copies = batch.column("copies").slice(a, n).to_pylist()
                fp = hasher.whole(t.word, t.at, 1).view(np.int64).tolist()
                raw, words, removed, kept, spans = t.data.tobytes(), np.diff(t.at), [], [], []
                for i, (lo, hi) in enumerate(zip(t.at, t.at[1:])):
                    if copies[i] and fp[i] in copies[i] and hi - lo >= window:
                        drop[lo:hi] = True
                    mine = drop[lo:hi]
                    parts = raw[t.start[lo] : t.end[hi - 1]].split() if hi > lo else []
                    if mine.any():
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                        keep = (~mine).tolist()
                        parts = [w for w, k in zip(parts, keep) if k]
                    else:
                        spans.append([])
                    removed.append(int(mine.sum()))
                    kept.append(b" ".join(parts))
                yield pa.record_batch([batch.column("doc_id").slice(a, n), pa.array(words), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, span)], names=["doc_id", "n_words", "n_removed", "kept", "removed"])

    return finish


def remove_repeats(docs: DataFrame, window: int = 20, seed: int = 0) -> DataFrame:
    """Remove each word that a window covers whose words also start earlier.

    Returns ``doc_id, n_words, n_removed, kept`` (kept words joined by a space)
    and ``removed`` (ranges of word numbers). Earlier is a smaller doc_id, or an
    earlier start in the document; all windows are judged on the input.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # no row is named by its id alone: ids may be null, or repeat, in any number of rows
    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("mark"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = packed.buckets_for(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (ENTRY_BYTES * BUCKET_ENTRIES))))
    first = store.table(keyed.mapInArrow(_first_level(window, buckets, seed), DEALT), "level")
    profile = first.where(F.col("kind") == PROFILE).select("doc", "mark", "n_words", "fp", "check")
    prints = profile.groupBy("fp").agg(F.min(F.struct("doc", "mark")).alias("first"), F.count("*").alias("copies"), (F.min("check") != F.max("check")).alias("clash"))
    prints = store.table(prints, "prints")
    if prints.where("clash").limit(1).count():  # two sequences, one fingerprint: 1 in 2**64 for a pair
        return remove_repeats(docs, window, seed + 1)
    several = profile.join(prints.where("copies > 1").select("fp", "first"), "fp")
    copies = several.where(F.col("doc") > F.col("first.doc")).select("doc", "mark", "fp").distinct()
    originals = prints.where("copies = 1").select("first.doc", "first.mark").union(several.where(F.col("doc") == F.col("first.doc")).select("doc", "mark").distinct())
    dealt, runs, row = first, levels(window), ["doc", "mark"]
    for level in range(1, len(runs)):
        open_ = _survivors(dealt, False, buckets).groupBy(*row).agg(F.flatten(F.collect_list("keys")).alias("keys")).join(originals, row, "left_semi")
        joined = keyed.join(open_, row)
        new = store.table(joined.mapInArrow(_next_level(window, level, buckets, seed), DEALT), "level")
        if level > 1:
            store.drop(spark, dealt)
        dealt = new
        store.release(spark)
    none = F.array().cast("array<long>")
    marks = _survivors(dealt, True, buckets).select(*row, none.alias("fp"), "keys").union(copies.select(*row, F.array("fp"), none))
    marks = store.table(marks.groupBy(*row).agg(F.flatten(F.collect_list("keys")).alias("keys"), F.flatten(F.collect_list("fp")).alias("copies")), "marks")
    store.drop(spark, dealt)
    store.release(spark)
    final = docs.withColumns({"doc": F.coalesce("doc_id", F.lit(LAST)), "mark": F.xxhash64("text")}).join(marks, row, "left").select("doc_id", "text", "keys", "copies")
    return final.mapInArrow(_finish(window, seed), "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: long, end: long>>")
