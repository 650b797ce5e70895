"""Exact Jaccard self-join on word n-grams, and the components of its links.

Rare-first prefix filtering: the sets' n-grams are ordered by document
frequency, and two sets that reach the threshold share an n-gram among the first
``n - ceil(t * n) + 1`` of each. Length, positional and suffix filters thin the
candidates, and each pair that is left is verified once.

1. ``profiles``: every document's n-gram count and the fingerprint of its word
   sequence. From here on a fingerprint is worked on once, whatever its copies.
2. ``_shared``: n-gram hashes go to hash buckets in compact blobs; a bucket counts
   each n-gram's documents and returns those of two documents or more. An n-gram
   of one document comes first in that document's order and links nothing, so
   documents whose prefix has only such n-grams end here.
3. ``_prefixes``, ``_verify``: rows of (n-gram, document) meet on the n-gram. First
   each n-gram's documents are held against the most typical of them alone, then,
   once the links so found are made components, those of different components
   against each other. So a group of thousands of near copies needs a pair each,
   not all pairs, and no link between components is lost. They meet by n-gram and
   band of set sizes, as sets that may link are of the same band or of neighbours.

The result is components: links inside a component are not all looked at, so there
is no number of links.

N-grams in more than ``HOT_SHARE`` of all documents (at most the mean set size /
``HOT_SHARE`` exist, whatever the input's size) stay out of the shuffle and come
last in every order.

Edge cases: null and blank texts have empty sets and are linked with nothing
(their component is their own id); a text of fewer than n words has its whole
sequence as its one n-gram; equal texts are linked; repeated and null ids are
taken as they are (the least id that is not null names a component), each row by its
own text; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components, packed, store
from .words import Hasher, Texts, chunks

HOT_SHARE = 0.01
#: Bits of an n-gram's hash that are sent. Two different n-grams of two given sets are taken for one in 1e9 pairs once.
HASH_BITS = 48
FLUSH = 1_000_000
#: Entries that a hash bucket is meant for: it is in memory as a whole.
BUCKET_ENTRIES = 2_000_000


def ngram_sets(texts: Texts, hasher: Hasher, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct n-gram hashes, sorted in each text, and their count by text."""
    words = np.diff(texts.at)
    many = np.maximum(0, words - n + 1)
    owner = np.repeat(np.arange(len(words)), many)
    at = np.repeat(texts.at[:-1] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    grams = hasher.runs(texts.word, n)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        grams = np.concatenate([grams, hasher.whole(texts.word, texts.at, 3)[short]])
        owner = np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.bincount(owner[new], minlength=len(words))


class _Gather:
    """Sets of distinct word sequences until enough are there to be sent."""

    def __init__(self):
        self.seen: set[int] = set()
        self.who, self.size, self.grams, self.held = [], [], [], 0

    def add(self, who: np.ndarray, grams: np.ndarray, size: np.ndarray) -> bool:
        new = np.array([x not in self.seen and not self.seen.add(x) for x in who.tolist()], bool) & (size > 0)
        self.who.append(who[new])
        self.size.append(size[new])
        self.grams.append(grams[np.repeat(new, size)] >> np.uint64(64 - HASH_BITS))
        self.held += len(self.grams[-1])
        return self.held >= FLUSH

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        empty = np.zeros(0, np.int64)
        out = np.concatenate([empty, *self.who]), np.concatenate([empty, *self.size]), np.concatenate([empty.astype(np.uint64), *self.grams])
        self.__init__()
        return out


def profiles(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """``doc_id, mark, fp, check, n_shingles`` (mark: a hash of the very text), and rows with a null ``n_shingles`` that hold often-seen n-grams (``hot``, ``times``)."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(seed), _Gather()
        names = ["doc_id", "mark", "fp", "check", "n_shingles", "hot", "times"]

        def often() -> pa.RecordBatch:
            who, _, grams = held.take()
            gram, times = np.unique(grams, return_counts=True)
            many = times >= max(4, HOT_SHARE * len(who))
            lists = lambda x: pa.array([x], pa.list_(pa.int64()))
            none = pa.nulls(1, pa.int64())
            return pa.record_batch([none, none, none, none, none, lists(gram[many].astype(np.int64)), lists(times[many])], names=names)

        for batch in batches:
            for t in chunks(batch.column("text"), hasher):
                fp, check = (hasher.whole(t.word, t.at, salt).view(np.int64) for salt in (1, 2))
                grams, size = ngram_sets(t, hasher, n)
                empty = pa.nulls(len(fp), pa.list_(pa.int64()))
                named = [batch.column(k).slice(int(t.rows[0]), len(fp)) for k in ("doc_id", "mark")]
                yield pa.record_batch([*named, pa.array(fp), pa.array(check), pa.array(size), empty, empty], names=names)
                if held.add(fp, grams, size):
                    yield often()
        yield often()

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return asked.mapInArrow(profile, "doc_id long, mark long, fp long, check long, n_shingles long, hot array<long>, times array<long>")


#: What a row of the exchange holds: entries to count; a flush's documents; entries that are an answer.
ENTRIES, DOCUMENTS, ANSWER = 0, 1, 2
ROW = "bucket int, flush long, kind int, blob binary"


def _shared(docs: DataFrame, n: int, seed: int, hot: np.ndarray, buckets: int, near: int) -> DataFrame:
    """``fp, n, keys``: each word sequence's n-grams that others have too, in rare-first order, if its prefix reaches one.

    A key is the n-gram's 48-bit hash below eight bits for its document frequency (in eighths of powers of two).
    Copies in several flushes count as several documents, which moves them all alike in the order.
    """
    hot = np.sort(hot).astype(np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, flush = Hasher(seed), _Gather(), TaskContext.get().partitionId() << 24

        def send(flush: int) -> pa.RecordBatch:
            who, size, grams = held.take()
            entry = np.repeat(np.arange(len(who)), size)
            common = np.isin(grams, hot)
            home = hash((flush >> 24, flush & 0xFFFFFF)) % buckets  # what needs no counting only passes through a bucket
            rows = [(home, DOCUMENTS, who.astype("<i8").tobytes() + size.astype("<i8").tobytes())]
            rows.append((home, ANSWER, packed.pack_answer(grams[common] | np.uint64(255 << HASH_BITS), entry[common])))
            rows += [(b, ENTRIES, blob) for b, blob in packed.pack_keys(grams[~common], entry[~common], None, buckets, HASH_BITS)]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([flush] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "flush", "kind", "blob"])

        for batch in batches:
            for t in chunks(batch.column("text"), hasher):
                grams, size = ngram_sets(t, hasher, n)
                if held.add(hasher.whole(t.word, t.at, 1).view(np.int64), grams, size):
                    yield send(flush)
                    flush += 1
        if held.held:
            yield send(flush)

    def count(group: pa.Table) -> pa.Table:
        kind, flush = group.column("kind").to_numpy(), group.column("flush").to_numpy()
        mine = kind == ENTRIES
        blobs = group.column("blob").filter(pa.array(mine)).to_pylist()
        grams, entry, _, part = packed.unpack_keys(blobs, group.column("bucket")[0].as_py(), buckets, HASH_BITS)
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        begin = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        times = np.diff(np.append(begin, len(grams)))
        times = np.repeat(times, times)
        again = times > 1
        rank = np.minimum(254, np.floor(8 * np.log2(times[again]))).astype(np.uint64)
        keys, order = (rank << np.uint64(HASH_BITS)) | grams[again], order[again]
        entry, part = entry[order], part[order]
        by_part = np.argsort(part, kind="stable")
        parts, first = np.unique(part[by_part], return_index=True)
        answers = [packed.pack_answer(keys[x], entry[x]) for x in np.split(by_part, first[1:])] if len(parts) else []
        passed = group.filter(pa.array(~mine)).select(["flush", "kind", "blob"])
        return pa.concat_tables([pa.table({"flush": flush[mine][parts], "kind": np.full(len(parts), ANSWER, np.int32), "blob": pa.array(answers, pa.binary())}), passed.cast(pa.schema([("flush", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())]))])

    def gather(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        of = lambda k: group.column("blob").filter(pa.array(kind == k)).to_pylist()
        who, size = np.frombuffer(of(DOCUMENTS)[0], "<i8").reshape(2, -1)
        keys, entry = packed.unpack_answers(of(ANSWER))
        have = np.bincount(entry, minlength=len(who))
        open_ = size - have < size - -(-size * near // 100) + 1
        kept = open_[entry]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(have[open_])]).astype(np.int32)), pa.array(keys[kept].astype(np.int64)))
        return pa.table({"fp": who[open_], "n": size[open_], "keys": lists})

    dealt = docs.select("text").mapInArrow(deal, ROW)
    answers = dealt.groupBy("bucket").applyInArrow(count, "flush long, kind int, blob binary")
    return answers.groupBy("flush").applyInArrow(gather, "fp long, n long, keys array<long>").dropDuplicates(["fp"])


def _prefix(n: Column, near: int) -> Column:
    """How many n-grams the prefix has: n - ceil(near / 100 * n) + 1."""
    return n - F.ceil(n * near / 100.0 - 1e-9) + 1


def _prefixes(shared: DataFrame, near: int) -> DataFrame:
    """A row for each n-gram in a prefix that some other document has. alone: n-grams of no other document, before all others.

    ``ranges`` counts a set's keys in four ranges of the hash, sixteen bits each, for the suffix filter.
    """
    alone = F.col("n") - F.size("keys")
    count = lambda r: F.least(F.lit(65535), F.size(F.filter("keys", lambda k: F.shiftright(k, HASH_BITS - 2).bitwiseAND(3) == r))).cast("long")
    ranges = count(0)
    for r in (1, 2):
        ranges = ranges.bitwiseOR(F.shiftleft(count(r), 16 * r))
    ranges = ranges.bitwiseOR(F.shiftleft(F.least(count(3), F.lit(32767)), 48))  # the sign bit stays free
    rows = shared.withColumns({"alone": alone, "ranges": ranges})
    return rows.select("fp", "n", "alone", "ranges", F.posexplode(F.slice("keys", F.lit(1), (_prefix(F.col("n"), near) - alone).cast("int"))).alias("place", "key")).withColumn("place", F.col("place") + F.col("alone"))


def _may_link(near: int) -> Column:
    """Length, positional and suffix filters on the candidate x, y (columns of _prefixes behind x_ and y_)."""
    c = F.col
    short, long, both = F.least(c("x_n"), c("y_n")), F.greatest(c("x_n"), c("y_n")), c("x_n") + c("y_n")
    length = short * 100 >= long * near
    # before the first n-gram that both have nothing is shared; with it at most the shorter rest
    most = F.least(c("x_n") - c("x_place"), c("y_n") - c("y_place"))
    place = most * (100 + near) >= both * near
    # the shared part differs in each range by at least the difference of its counts
    part = lambda x, r: F.shiftright(c(x), 16 * r).bitwiseAND(65535 if r < 3 else 32767)
    apart = c("x_alone") + c("y_alone")
    for r in range(4):
        apart = apart + F.abs(part("x_ranges", r) - part("y_ranges", r))
    suffix = (both - apart) * (100 + near) >= both * 2 * near
    return length & place & suffix


def _band(n: Column, near: int) -> Column:
    """The band of set size n: sizes whose sets may link are of one band or of neighbours."""
    return F.floor(F.log(n) / math.log(100 / near) + 1e-9).cast("int") if near < 100 else n.cast("int")


def _as(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(k) if k in ("key", "band") else F.col(k).alias(f"{side}_{k}") for k in df.columns])


def _verify(pairs: DataFrame, shared: DataFrame, near: int) -> DataFrame:
    """The pairs ``a, b`` that reach the threshold. Every common n-gram is among the shared keys."""
    rows = pairs.join(shared.select(F.col("fp").alias("a"), F.col("n").alias("an"), F.col("keys").alias("ak")), "a")
    rows = rows.join(shared.select(F.col("fp").alias("b"), F.col("n").alias("bn"), F.col("keys").alias("bk")), "b")
    same = F.size(F.array_intersect("ak", "bk"))
    return rows.where(same * 100 >= (F.col("an") + F.col("bn") - same) * near).select("a", "b")


def _pair() -> list[Column]:
    return [F.least("x_fp", "y_fp").alias("a"), F.greatest("x_fp", "y_fp").alias("b")]


def links_and_groups(shared: DataFrame, near: int) -> tuple[DataFrame, list[DataFrame]]:
    """``fp, group`` for all word sequences that are linked with another one, and the working tables that can go."""
    rows = store.table(_prefixes(shared, near), "prefixes")
    # the most typical document of an n-gram: the smallest share of n-grams that no other has
    typical = rows.groupBy("key").agg(F.min(F.struct((F.col("alone") / F.col("n")).alias("share"), "fp", "n", "alone", "ranges", "place")).alias("y"), F.count("*").alias("many")).where("many > 1")
    typical = typical.select("key", *[F.col(f"y.{k}").alias(f"y_{k}") for k in ("fp", "n", "alone", "ranges", "place")])
    tried = store.table(_as(rows, "x").join(typical, "key").where((F.col("x_fp") != F.col("y_fp")) & _may_link(near)).select(*_pair()).distinct(), "pairs")
    links = store.table(_verify(tried, shared, near), "links")
    groups = store.table(components.connected_components(links), "groups")
    named = rows.join(groups, rows["fp"] == groups["node"], "left").select(*rows.columns, F.coalesce("component", "fp").alias("group"))
    named = store.table(named, "prefixes")
    mixed = named.groupBy("key").agg((F.min("group") != F.max("group")).alias("mixed")).where("mixed").select("key")
    open_ = store.table(named.join(mixed, "key", "left_semi"), "prefixes")
    # x is of y's band or the next: y goes to both
    banded = open_.withColumn("own", _band(F.col("n"), near))
    x, y = _as(banded.withColumn("band", F.col("own")), "x"), _as(banded.withColumn("band", F.explode(F.array("own", F.col("own") + 1))), "y")
    once = F.when(F.col("x_own") == F.col("y_own"), F.col("x_group") < F.col("y_group")).otherwise(F.col("x_group") != F.col("y_group"))
    rest = x.join(y, ["key", "band"]).where(once & _may_link(near)).select(*_pair()).distinct()
    rest = store.table(rest.join(tried, ["a", "b"], "left_anti"), "pairs")
    more = store.table(_verify(rest, shared, near).union(links), "links")
    found = components.connected_components(more).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    return found, [rows, tried, links, groups, named, open_, rest, more]


def _components(docs: DataFrame, n: int, near: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Each row's profile (``doc_id, mark, fp, n_shingles``), and each word sequence's component (``fp, copies, component_id, component_mark``)."""
    spark = docs.sparkSession
    store.small_batches(spark)
    both = store.table(profiles(docs, n, seed), "profiles")
    known = both.where("n_shingles IS NOT NULL").drop("hot", "times")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    prints = known.where("n_shingles > 0").groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("copies"), F.max("n_shingles").alias("size"), (F.min("check") != F.max("check")).alias("clash"))
    prints = store.table(prints, "prints")
    total, entries, clash = prints.agg(F.count("*"), F.sum("size"), F.max("clash")).first()
    if clash:  # two sequences, one fingerprint: 1 in 2**64 for a pair
        return _components(docs, n, near, seed + 1)
    often = both.where("n_shingles IS NULL").select(F.explode(F.arrays_zip("hot", "times")).alias("x")).groupBy("x.hot").agg(F.sum("x.times").alias("times"))
    hot = [r[0] for r in often.where(F.col("times") >= max(16, HOT_SHARE * total / 2)).select("hot").toLocalIterator()]
    buckets = packed.buckets_for(max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(entries or 0) // BUCKET_ENTRIES)))
    shared = store.table(_shared(docs, n, seed, np.array(hot, np.int64), buckets, near), "shared")
    store.release(spark)
    groups, spent = links_and_groups(shared, near)
    named = prints.join(groups, "fp", "left").select("fp", "first", "copies", F.coalesce("group", "fp").alias("group"))
    least = named.groupBy("group").agg(F.min("first").alias("least"))
    named = named.join(least, "group").select("fp", "copies", F.col("least.doc_id").alias("component_id"), F.col("least.mark").alias("component_mark"))
    named = store.table(named, "named")
    store.drop(spark, shared, prints, *spent)
    return known, named


def ngram_components(docs: DataFrame, n: int = 5, near: int = 75) -> DataFrame:
    """Components of the links ``100 * intersection >= near * union`` between the documents' n-gram sets.

    Returns ``doc_id, n_shingles, component_id`` and ``copies`` (documents of the very same word sequence).
    """
    known, named = _components(docs, n, near)
    return known.join(named, "fp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("copies", F.lit(1)).alias("copies")
    )


def keep_one(docs: DataFrame, n: int = 5, near: int = 75) -> DataFrame:
    """The rows of ``docs``, all columns, without those that another document of their component stands for.

    That of the least id stays (of one id, that of the least hash of its text; rows without id come last), one
    row of it where it is repeated. Rows without words are linked with nothing, so all of them stay.
    """
    known, named = _components(docs, n, near)
    rows = known.join(named, "fp", "left")
    chosen = rows.where((F.col("n_shingles") == 0) | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("component_mark"))))
    keys = chosen.groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark")).agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("_again"))
    keys = store.table(keys, "kept")
    marked = docs.select(F.struct(*[docs[k] for k in docs.columns]).alias("_row"), docs["doc_id"].cast("long").alias("_id"), F.xxhash64(docs["text"]).alias("_text"))
    # the list of kept rows has no bound, so it is merged at every size and never broadcast
    kept = marked.join(keys.hint("shuffle_merge"), F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_mark")))
    if keys.where("_again").limit(1).count():
        kept = kept.where("NOT _again").unionByName(kept.where("_again").dropDuplicates(["_doc", "_mark"]))
    return kept.select("_row.*")
