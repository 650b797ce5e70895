"""Operators 11 to 13 on odd tables and against brute force that shares no code with them."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import hard_negatives, hmm, yinyang
from postlens.llm import queries as Q

VECTORS = "vec_id long, embedding array<double>, label int, size string, row string, vector string, code string, _label string"


def table(spark, rows):
    """Vectors with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, label, "s", "r", "v", "c", "l") for i, v, label in rows], VECTORS)


def kept(rows, scale=256):
    good = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return sorted(good, key=lambda r: (r[0] is None, r[0] or 0))


def some(n, dims, seed, odd=True):
    r = random.Random(seed)
    rows = [(i, [round(r.gauss(0, 1), 2) for _ in range(dims)], r.choice([0, 1, 2, None])) for i in range(n)]
    rows += [(n + k, rows[k % min(7, n)][1], 1) for k in range(12)]  # copies: ties
    if odd:
        rows += [(900, None, 1), (901, [None] * dims, 1), (902, [float("nan")] * dims, 1), (903, [float("inf")] + [0.0] * (dims - 1), 0), (None, [0.5] * dims, 2)]
    return rows


# 11: Yinyang


def plain_codes(rows, parts, entries, rounds):
    """Lloyd without bounds, in Python's integers."""
    data = kept(rows)
    each = -(-len(data[0][2]) // parts)
    cut = [[(v + [0] * (parts * each))[p * each : (p + 1) * each] for p in range(parts)] for _, _, v in data]
    books = [[list(row[p]) for row in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(near(row[p], books[p]), []).append(row[p])
            for e, mine in groups.items():
                books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (i, label, _), row in zip(data, cut):
        code = [near(row[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{c:02x}" for c in code), sum(sum((a - b) ** 2 for a, b in zip(row[p], books[p][code[p]])) for p in range(parts))))
    total = Counter()
    for _, label, _, error in out:
        total[label] += error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((*r, total[r[1]], hashlib.sha256(text.encode()).hexdigest()) for r in out), key=repr)


def codes(df, **more):
    return sorted((tuple(r)[:6] for r in yinyang.encode(df, **more).collect()), key=repr)


@pytest.mark.parametrize("dims, parts, entries, rounds", [(8, 4, 20, 2), (8, 4, 64, 3), (6, 4, 25, 2), (3, 1, 30, 0)])
def test_codes(spark, dims, parts, entries, rounds):
    rows = some(150, dims, dims)
    assert codes(table(spark, rows).repartition(3), parts=parts, entries=entries, rounds=rounds) == plain_codes(rows, parts, entries, rounds)


def test_codes_of_odd_tables(spark):
    assert yinyang.encode(table(spark, some(1, 4, 1)).limit(0)).collect() == []
    few = [(5, [0.1, 0.2], None), (5, [0.1, 0.2], 1), (7, [3.0, -2.0], 1)]
    assert codes(table(spark, few), parts=2) == plain_codes(few, 2, 64, 2)
    huge = [(i, [x * 1e15, -x * 3e13], 0) for i, x in enumerate((0.5, 1.25, 1.5, 7.0, 7.5, -3.0))]
    got = codes(table(spark, huge), parts=1, entries=2)
    want = plain_codes([(i, v, label) for i, v, label in huge], 1, 2, 2)
    cap = lambda e: min(e, (1 << 63) - 1)
    assert got == [(*r[:3], cap(r[3]), cap(sum(cap(x[3]) for x in want)), r[5]) for r in want]
    mixed = some(40, 4, 3) + [(i + 100, [0.5 * i, 1.0], 0) for i in range(5)] + [(200, [], 0)]
    assert len({r[5] for r in codes(table(spark, mixed), parts=2, entries=8)}) == 3
    by_size = {r.vec_id: r.code for r in yinyang.encode(table(spark, mixed), parts=2, entries=8).collect()}
    alone = {r[0]: r[2] for r in plain_codes([r for r in mixed if r[1] is not None and len(r[1]) == 2], 2, 8, 2)}
    assert {k: by_size[k] for k in alone} == alone and by_size[200] == "0000"
    with pytest.raises(ValueError):
        yinyang.encode(table(spark, few), entries=300)


def test_bounds_spare_distances():
    """In later rounds, most groups are not looked at, and the outcome is that of looking at all."""
    r = np.random.default_rng(4)
    centres = r.integers(-2000, 2000, (60, 4))
    x = (centres[r.integers(0, 60, 5000)] + r.integers(-40, 40, (5000, 4))).astype(float)
    entries = centres.astype(float)
    group = yinyang.groups_of(entries, 6)
    code, _, low, first = yinyang.assign(x, entries, group, np.zeros(6), True)
    moved = entries + r.integers(-5, 5, entries.shape)
    drift = np.array([np.sqrt(((moved - entries) ** 2).sum(1))[group == g].max() for g in range(6)])
    new, best, low, looked = yinyang.assign(x, moved, group, drift, True, code, low)
    far = ((x[:, None] - moved[None]) ** 2).sum(2)
    assert (new == far.argmin(1)).all() and (best == far.min(1)).all() and looked < 0.4 * first
    for g in range(6):  # bounds hold for all but the own entry
        others = np.where((group == g)[None, :] & (np.arange(60)[None, :] != new[:, None]), far, np.inf).min(1)
        assert (low[:, g] <= np.sqrt(others)).all()


# 12: hard negatives


def plain_negatives(rows, every, positives, k, low, high, scale=256):
    data = [(i, label, v) for i, label, v in kept(rows, scale) if label is not None]
    name = lambda i: (i is None, i or 0)
    out = []
    for a, (i, label, v) in enumerate(data):
        if i is None or i % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), name(j), b, other, j) for b, (j, other, w) in enumerate(data) if b != a and len(w) == len(v)]
        scores.sort()
        for p in [s for s in scores if s[3] == label][:positives]:
            fits = [s for s in scores if s[3] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0]][:k]
            out += [(i, p[4], n, s[4], -p[0], -s[0]) for n, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def negatives(df, **more):
    return sorted((tuple(r)[:6] for r in hard_negatives.mine(df, **more).collect()), key=repr)


@pytest.mark.parametrize("dims, seed", [(4, 1), (7, 2)])
def test_hard_negatives(spark, dims, seed, monkeypatch):
    rows = some(260, dims, seed)
    want = plain_negatives(rows, 10, 5, 3, 50, 95)
    assert len(want) > 100 and negatives(table(spark, rows).repartition(3), every=10) == want
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * dims * 7)  # blocks of seven anchors
    assert negatives(table(spark, rows), every=10) == want
    assert negatives(table(spark, rows), every=10, positives=1, k=1, low=0, high=100) == plain_negatives(rows, 10, 1, 1, 0, 100)


def test_hard_negatives_of_odd_tables(spark):
    assert negatives(table(spark, some(3, 2, 1)).limit(0)) == [] and negatives(table(spark, [(0, [1.0], None)])) == []
    same = [(i, [1.0, 1.0], i % 2) for i in range(30)]  # all scores equal: no window holds them below 95 %
    assert negatives(table(spark, same), every=10) == [] and negatives(table(spark, same), every=10, high=100) == plain_negatives(same, 10, 5, 3, 50, 100)
    twice = [(0, [1.0, 0.0], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.1], 0), (2, [0.6, 0.3], 2)]
    assert negatives(table(spark, twice)) == plain_negatives(twice, 50, 5, 3, 50, 95)
    big = [(i, [x * 1e6, 1e6], i % 2) for i, x in enumerate((1.0, 0.7, 0.9, 0.8, 1.1, 0.6))]  # products beyond 2**53
    assert negatives(table(spark, big), every=2) == plain_negatives(big, 2, 5, 3, 50, 95)
    mixed = some(40, 3, 5) + [(300 + i, [1.0 * i], i % 2) for i in range(6)]
    assert negatives(table(spark, mixed), every=10) == plain_negatives(mixed, 10, 5, 3, 50, 95)


def test_lists_merge_in_any_order():
    r = np.random.default_rng(2)
    score, ids = r.integers(0, 20, 400), r.integers(0, 50, 400)
    which, rows = r.integers(0, 3, 400), np.arange(400)
    want = {(w, *t) for w in range(3) for t in sorted(((-s, i, q) for v, s, i, q in zip(which, score, ids, rows) if v == w))[:5]}
    for order in (rows, rows[::-1], r.permutation(400)):
        best = hard_negatives.Best(3, 5)
        for part in np.array_split(order, 9):
            best.add(which[part], score[part], ids[part], rows[part])
        assert {(w, -s, i, q) for w, s, i, q in zip(*(x.tolist() for x in best.rows()))} == want


# 13: hidden Markov model

BLANK = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, hash string, words string, classes string, block int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "h", "w", "c", 1) for i, t in rows], DOCS)


def corpus(n=60, seed=1):
    r = random.Random(seed)
    topics = [[f"{k}{j}" for j in range(12)] for k in "abc"]
    rows = [(i, " ".join(r.choice(r.choice(topics) if r.random() < 0.1 else topics[i % 3]) for _ in range(r.randint(1, 150)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n "), (None, "A0 b1"), (3, rows[3][1]), (3, "other text"), (n + 3, "new1 new2 a1"), (n + 4, "a b \x0bA1\x1ca2")]


def words(text):
    low = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    for ch in BLANK[1:]:
        low = low.replace(ch, " ")
    return [w for w in low.split(" ") if w]


def plain_base(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for i, t in rows if not held(i) for w in [*words(t), ""])  # "" stands for the end
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = [*words(t), ""]
        out.append((i, held(i), len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out, count


def close(a, b):
    key = lambda r: (repr(r[:5]), r[5:])
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert [r[:5] for r in a] == [r[:5] for r in b]
    for x, y in zip(a, b):
        assert all(abs(p - q) <= 1e-9 * max(1.0, abs(p)) for p, q in zip(x[5:], y[5:])), (x, y)


def test_base_scores(spark):
    rows = corpus()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in hmm.score(docs(spark, rows).repartition(3), states=1).collect()]
    close(got, plain_base(rows)[0])


@pytest.mark.parametrize("frequent", [16384, 40])
def test_one_state_knows_words_alone(spark, frequent, monkeypatch):
    """Without states the model is the smoothed distribution of words, whichever of them are classes of their own; each rare class has an unknown word."""
    monkeypatch.setattr(hmm, "FREQUENT", frequent)
    rows = corpus()
    base, count = plain_base(rows)
    total = sum(count.values()) + 0.5 * (len(count) + hmm.RARE)
    want = [(*b[:5], sum(math.log10((count[w] + 0.5) / total) for w in [*words(t), ""])) for b, (_, t) in zip(base, rows)]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in hmm.score(docs(spark, rows), states=1).collect()]
    close(got, want)


def plain_forward_backward(start, move, emit, token):
    """Token by token, with Python's floats: the logarithm of the likelihood, and expected starts, moves and emissions."""
    states = range(len(start))
    forward, log = [], 0.0
    for t, k in enumerate(token):
        a = [(start[s] if t == 0 else sum(forward[-1][r] * move[r][s] for r in states)) * emit[k][s] for s in states]
        total = sum(a)
        log += math.log(total)
        forward.append([x / total for x in a])
    backward = [[1.0] * len(start)]
    for k in reversed(token[1:]):
        b = [sum(move[s][r] * emit[k][r] * backward[0][r] for r in states) for s in states]
        backward.insert(0, [x / sum(b) for x in b])
    first, moves, seen = np.zeros(len(start)), np.zeros((len(start), len(start))), np.zeros((len(emit), len(start)))
    for t, k in enumerate(token):
        g = np.array([forward[t][s] * backward[t][s] for s in states])
        g /= g.sum()
        seen[k] += g
        first += g * (t == 0)
        if t + 1 < len(token):
            x = np.array([[forward[t][s] * move[s][r] * emit[token[t + 1]][r] * backward[t + 1][r] for r in states] for s in states])
            moves += x / x.sum()
    return log, first, moves, seen


def test_recursion_is_exact():
    r = np.random.default_rng(3)
    model = hmm.Model.new(r.gamma(1.0, 1.0, 30) + 0.01, 3, 1)
    n = np.array([1, 2, 63, 64, 65, 128, 300, 5])
    token = r.integers(0, 30, n.sum())
    done = hmm.Recursion(model, hmm.Pieces(token, n))
    counts = [x / hmm.UNIT for x in done.counts()]
    total = [np.zeros(3), np.zeros((3, 3)), np.zeros((30, 3))]
    for i, (a, b) in enumerate(zip(np.cumsum(n) - n, np.cumsum(n))):
        log, *mine = plain_forward_backward(model.start.tolist(), model.move.tolist(), model.emit.tolist(), token[a:b].tolist())
        assert abs(log - done.log[i]) < 1e-9 * abs(log)
        total = [x + y for x, y in zip(total, mine)]
    for got, want in zip(counts, total):
        assert np.abs(got - want).max() < 1e-3


def test_training_adds_up_over_partitions(spark, monkeypatch):
    """Another partitioning, the same model; Baum-Welch rounds raise the likelihood of the training texts; states beat single words on held-out ones."""
    monkeypatch.setattr(hmm, "FREQUENT", 40)
    rows = corpus(150, 7)
    show = lambda df: sorted((repr(r.doc_id), r.n_tokens, round(r.score, 6)) for r in df.collect())
    one = show(hmm.score(docs(spark, rows).coalesce(1), states=3))
    assert one == show(hmm.score(docs(spark, rows).repartition(5), states=3))
    coded, classes = hmm.coded(docs(spark, rows))
    train = coded.where("NOT held_out")
    before = {k: hmm.trained(train, classes, 3, k) for k in (0, 1, 3)}
    batches = train.select("classes").toArrow().combine_chunks().to_batches()
    likelihood = {k: sum(hmm.Recursion(m, p).log.sum() for _, p in hmm._batches(iter(batches), classes.end())) for k, m in before.items()}
    assert likelihood[0] < likelihood[1] < likelihood[3]
    ends = {k: hmm.score(docs(spark, rows), states=k).where("held_out").agg(F.sum("score")).first()[0] for k in (1, 3)}
    assert ends[3] > ends[1] + 50


def test_texts_of_odd_tables(spark):
    assert hmm.score(docs(spark, [(1, "a")]).limit(0)).collect() == []
    unseen = [(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = hmm.score(docs(spark, unseen)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] * 3 and all(math.isfinite(r.score) for r in got)


def test_a_very_long_text(spark):
    r = random.Random(9)
    text = " ".join(f"w{r.randint(0, 300)}" for _ in range(1_200_000))
    rows = docs(spark, [(1, "w1 w2"), (3, None)]).unionByName(spark.range(2, 3).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("hash", "string"), ("words", "string"), ("classes", "string"), ("block", "int"))]))
    got = {x.doc_id: x for x in hmm.score(rows, states=2, rounds=1).collect()}
    assert got[2].n_tokens == 1_200_001 and math.isfinite(got[2].score) and abs(got[2].base_score / got[2].n_tokens + math.log10(301)) < 0.05


def test_language_model_query(spark, sf):
    rows = Q.op13_hmm(spark, sf).collect()
    plain, _ = plain_base([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    close([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows], plain)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_language_model_learns_from_all_documents_in_each_round(spark):
    r = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in r.zipf(1.5, n) % 50)) for i, n in enumerate([6000, 3, 40, 5000, 200, 1, 90, 4500])]
    coded, classes = hmm.coded(docs(spark, rows))
    train = coded.where("NOT held_out")
    start = hmm.Model.new(classes.mass, 3)
    plain = [np.zeros(3), np.zeros((3, 3)), np.zeros(start.emit.shape)]
    for _, pieces in hmm._batches(iter(train.select("classes").toArrow().combine_chunks().to_batches()), classes.end()):
        plain = [a + b for a, b in zip(plain, hmm.Recursion(start, pieces).counts())]
    want, got = start.updated(*(x / hmm.UNIT for x in plain), classes.mass), hmm.trained(train, classes, 3, 1)
    assert all(np.allclose(getattr(want, k), getattr(got, k)) for k in ("start", "move", "emit"))
