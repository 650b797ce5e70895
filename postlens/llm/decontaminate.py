"""Benchmark decontamination by spaced-seed hashing.

DataFrame functions only. A seed hashes the words at a mask's places and ignores
those between, so a hit survives substitutions there. The masks of an item are such
that each pattern of agreeing words that the verdict accepts holds one of them
(``masks_for``), so nothing that would pass is left unseen. Hits of a document and a
benchmark item on one diagonal (document place less item place) are verified
once, on the texts: somewhere along the diagonal ``window`` aligned words must
agree in at least ``least`` places (an item of fewer words: in that share of all).

Words are runs of letters and digits in lower case. The seeds of the benchmark
are broadcast at most ``SEEDS_AT_ONCE`` at a time, so a benchmark of any size is
joined in blocks of proven size and the corpus is never shuffled to find hits.
To verify them, only documents in a hash bucket of one with a hit are joined; the
``BUCKETS`` numbers are all that is broadcast, however many documents have hits.

Edge cases: null and short texts have no seeds that an item has; items of fewer than
``SHORTEST`` words are not looked for; null item texts are left out; rows that
share a doc_id, or have none, are judged each by its own text (equal texts of one id are one document); of
equal windows on several diagonals the first in the document is told; empty tables give
an empty result. Only ``doc_id, text`` and ``item_id, text`` are read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

#: Fixed masks: the places with a 1 are hashed. The first hold for 10 of 13 and 10 of 12 words, the second for items of 6 to 11.
MASKS = ("111011", "110111", "1101000011")
SHORT_MASKS = ("11101", "100111")
#: Patterns up to which masks are tried on all.
PATTERNS = 20_000
SHORTEST = 6
SEEDS_AT_ONCE = 1_000_000
BUCKETS = 1 << 20
#: Leaking documents that are broadcast; more are joined by bucket.
LEAKS_AT_ONCE = 1_000_000
SEPARATORS = r"[^\p{L}\p{N}]+"


def tokens(text: str = "text") -> Column:
    """Words in lower case; an empty one may stand at either end."""
    return F.split(F.lower(F.col(text)), SEPARATORS)


def finds_all(masks: tuple[str, ...], wide: int, need: int) -> bool:
    """Whether any ``need`` agreeing words out of ``wide`` hold all places of one of the masks somewhere."""
    shifted = [sum(1 << (k + i) for k, bit in enumerate(m) if bit == "1") for m in masks for i in range(wide - len(m) + 1)]
    return all(any(x & ~found == 0 for x in shifted) for found in (sum(1 << i for i in places) for places in combinations(range(wide), need)))


def masks_for(wide: int, need: int) -> tuple[str, ...]:
    """Masks that miss no pattern of ``need`` agreeing words out of ``wide``."""
    need = max(1, min(need, wide))
    if math.comb(wide, need) <= PATTERNS:
        for masks in (MASKS, SHORT_MASKS):
            if finds_all(masks, wide, need):
                return masks
    # the words that differ leave a run of so many that agree
    return ("1" * -(-need // (wide - need + 1)),)


def _seeds(words: str, mask: str, places: Column) -> Column:
    """The hashes of a mask at the places (from 1) of the word-hash column ``words``; beyond its end words are missing, and the hash is no item's."""
    at = [k for k, bit in enumerate(mask) if bit == "1"]
    return F.transform(places, lambda i: F.xxhash64(F.lit(mask), *[F.get(F.col(words), i + (k - 1)) for k in at]))


def _key() -> dict[str, Column]:
    """What names a document: its id and a hash of its text, which tells null ids from others."""
    none = F.col("doc_id").isNull()
    return {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "mark": F.xxhash64("text", none)}


def _bucket(doc: Column, mark: Column) -> Column:
    return F.pmod(F.xxhash64(doc, mark), F.lit(BUCKETS)).cast("int")


def _buckets(found: DataFrame) -> DataFrame:
    """The buckets of the documents in ``found``: at most BUCKETS numbers."""
    return F.broadcast(found.select(_bucket(F.col("doc"), F.col("mark")).alias("_bucket")).distinct())


def _hits(docs: DataFrame, seeds: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``doc, mark, item_id, diagonal`` for each place where a document has a seed of an item."""
    rows = docs.select("doc", "mark", F.transform(tokens(), lambda w: F.xxhash64(w)).alias("words"))
    # all masks in one pass: their seeds one behind the other, as many of each
    count = F.greatest(F.lit(1), F.size("words") - min(map(len, masks)) + 1)
    seeds_of = F.concat(*[_seeds("words", m, F.sequence(F.lit(1), count)) for m in masks])
    found = rows.select("doc", "mark", count.alias("count"), F.posexplode(seeds_of).alias("place", "seed"))
    found = found.select("doc", "mark", F.pmod("place", "count").alias("place"), "seed")
    return found.join(F.broadcast(seeds), "seed").select("doc", "mark", "item_id", (F.col("place") - F.col("at")).alias("diagonal"))


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int, least: int) -> DataFrame:
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", F.filter(tokens(), lambda w: w != "").alias("item_words"))
    items = store.table(items.where(F.size("item_words") >= SHORTEST), "items")
    hashed = items.withColumn("words", F.transform("item_words", lambda w: F.xxhash64(w)))
    wide = F.least(F.lit(window), F.size("words"))
    of_length: dict[str, list[int]] = {}
    for (n,) in hashed.select(wide).distinct().collect():
        for mask in masks_for(n, -(-n * least // window)):
            of_length.setdefault(mask, []).append(n)
    if not of_length:
        of_length = {mask: [window] for mask in MASKS}
    masks = tuple(sorted(of_length))
    seeds = None
    for mask in masks:
        of = hashed.where(wide.isin(of_length[mask]))
        rows = of.select("item_id", F.posexplode(_seeds("words", mask, F.sequence(F.lit(1), F.size("words") - len(mask) + 1))).alias("at", "seed"))
        seeds = rows if seeds is None else seeds.unionByName(rows)
    seeds = store.table(seeds, "seeds")
    blocks = max(1, -(-seeds.count() // SEEDS_AT_ONCE))
    keyed = docs.where(F.col("text").isNotNull()).select(*[v.alias(k) for k, v in _key().items()], F.col("doc_id").isNull().alias("nameless"), "text")
    hits = None
    for k in range(blocks):
        found = _hits(keyed, seeds.where(F.pmod("seed", F.lit(blocks)) == k), masks)
        hits = found if hits is None else hits.unionByName(found)
    hits = store.table(hits.distinct(), "hits")
    touched = keyed.join(_buckets(hits), _bucket(F.col("doc"), F.col("mark")) == F.col("_bucket"), "left_semi")
    pairs = touched.join(hits, ["doc", "mark"]).join(items, "item_id").withColumn("words", tokens())
    n, m = F.size("words"), F.size("item_words")
    skip = F.greatest(F.lit(0), -F.col("diagonal"))  # item words before the document
    start = F.greatest(F.lit(0), F.col("diagonal"))
    length = F.greatest(F.lit(0), F.least(n - start, m - skip))
    agree = F.zip_with(F.slice("words", start + 1, length), F.slice("item_words", skip + 1, length), lambda a, b: F.when(a == b, 1).otherwise(0))
    # written, as the windows below would otherwise split the text again at each place
    pairs = store.table(pairs.select("doc", "mark", "nameless", "item_id", "diagonal", m.alias("item_size"), agree.alias("same")), "overlaps")
    m = F.col("item_size")
    wide = F.least(F.lit(window), m)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("same") - wide + 1)), lambda i: F.aggregate(F.slice("same", i, wide), F.lit(0), lambda a, b: a + b)))
    checked = pairs.select("doc", "mark", "nameless", "item_id", "diagonal", best.alias("matched"), wide.alias("aligned")).where(F.col("matched") * window >= F.col("aligned") * least)
    one = checked.groupBy("doc", "mark", "nameless", "item_id").agg(F.max(F.struct("matched", (-F.col("diagonal")).alias("d"), "aligned")).alias("x"))
    return one.select("doc", "mark", "nameless", "item_id", (-F.col("x.d")).alias("diagonal"), F.col("x.matched").alias("matched"), F.col("x.aligned").alias("aligned"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 13, least: int = 10) -> DataFrame:
    """``doc_id, item_id, diagonal, matched, aligned``: documents that hold a passage of a benchmark item, a row for each text and item.

    matched: agreeing words in the best window (of ``aligned`` words); diagonal:
    the word of the document at which the item would begin.
    """
    found = _leaks(docs, benchmark, window, least)
    return found.select(F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), "item_id", "diagonal", "matched", "aligned")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 13, least: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without the documents that hold a benchmark passage."""
    leaks = store.table(_leaks(docs, benchmark, window, least).select("doc", "mark").distinct(), "leaks")
    key = _key()
    same = (key["doc"] == leaks["doc"]) & (key["mark"] == leaks["mark"])
    if leaks.count() <= LEAKS_AT_ONCE:
        return docs.join(F.broadcast(leaks), same, "left_anti")
    # most documents pass by their bucket alone; the others meet the list in a join that no side need be small for
    buckets = _buckets(leaks)
    listed = _bucket(key["doc"], key["mark"]) == buckets["_bucket"]
    return docs.join(buckets, listed, "left_anti").unionByName(docs.join(buckets, listed, "left_semi").join(leaks, same, "left_anti"))
