"""The pipeline's stages against plain Python, each on its own input."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from postlens.llm.queries import token_vocabulary  # noqa: E402
from tests.llm.test_operators import EXTRA, brute_components, digests, plain_ids, table  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf):
    from postlens.llm import store

    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(("documents", docs.toPandas()))
    for name, stage in corpus_pipeline.STAGES:
        docs = store.table(stage(spark, docs, sf), name)
        out.append((name, docs.toPandas()))
    return out


def test_columns(stages):
    for name, rows in stages[:-1]:
        assert list(rows.columns) == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_languages_keep_clean_documents(stages):
    before, after = stages[0][1], stages[1][1]
    gone = before[~before.doc_id.isin(after.doc_id)]
    assert len(gone) <= 2 and all(len(t) < 40 for t in gone.text)


def test_one_of_each_group_stays(stages):
    before, after = stages[1][1], stages[2][1]
    groups = brute_components(list(zip(before.doc_id, before.text)))
    assert sorted(after.doc_id) == sorted({c for _, c in groups.values()})


def test_no_benchmark_passage_is_left(stages, sf, spark):
    before, after = stages[2][1], stages[3][1]
    words = lambda t: re.findall(r"\w+", t.lower())
    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[k : k + 13]) for w in items for k in range(len(w) - 12)}
    held = {i for i, t in zip(before.doc_id, before.text) for w in [words(t)] for k in range(len(w) - 12) if tuple(w[k : k + 13]) in grams}
    assert held and not held & set(after.doc_id)
    assert set(before.doc_id) - set(after.doc_id) == held


def test_mix_repeats_up_to_three_times(stages):
    before, after = stages[3][1], stages[4][1]
    counts = Counter(after.doc_id)
    assert set(counts) <= set(before.doc_id) and max(counts.values()) <= 3


def test_tokens(stages):
    docs, got = stages[4][1], stages[5][1].sort_values("start")
    want = digests(plain_ids(sorted(zip(docs.doc_id, docs.text))))
    assert sorted((i, n, crc) for i, _, n, crc in (tuple(r) for r in got.itertuples(index=False))) == sorted((i, n, crc) for i, _, n, crc in want)
    assert list(got.doc_id) == sorted(docs.doc_id) and list(got.start) == [s for _, s, _, _ in want]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents():
    words = {"en": "the of and house river with under stone".split(), "de": "der und über häuser fluß mit stein für".split()}
    text = lambda lang, k: " ".join(words[lang][(k * 7 + j * j + j * k) % 8] + ("" if j % 5 else str(j * k % 11)) for j in range(12 + k % 30))
    rows = [(i, text(lang, i), lang, ["a", None, "b"][i % 3], 1) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [(5, text("de", 99), "de", "a", None), (5, text("de", 99), "de", "a", None), (6, text("en", 6), "en", None, 1), (None, text("en", 70), None, None, None), (None, text("de", 71), "de", "b", 2), (None, text("en", 0), "en", "a", 2)]
    return rows + [(300, None, "en", "a", 0), (301, "", "en", "a", 0), (302, "12 ?!", None, "b", 5), (303, "the river " * 40000, "en", "a", 1), (None, None, None, None, None)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, sf, name):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns, empty tables: no stage fails, clean rows stay."""
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = odd_documents()
    docs = table(spark, rows, DOCUMENTS, extra=name != "token_ids")
    got = stage(spark, docs, sf)
    assert stage(spark, docs.limit(0), sf).count() == 0
    if name == "token_ids":
        assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect()))) == sorted(str((i, n, crc)) for i, _, n, crc in digests(plain_ids([(r[0], r[1]) for r in rows])))
        return
    assert got.columns == docs.columns and set(EXTRA) <= set(got.columns)
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    given = Counter((r[0], r[1]) for r in rows)
    if name == "language_id":
        assert kept == Counter({k: n for k, n in given.items() if any(c.isalpha() for c in k[1] or "")})
    if name == "ngram_join":
        firsts = {}
        numbered = list(enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))))
        groups = brute_components([(k, r[1]) for k, r in numbered])
        for k, r in numbered:
            if groups[k][0] == 0 or groups[k][1] == k:
                firsts[k] = (r[0], r[1])
        assert sum(kept.values()) == len(firsts) and {str(i) for i, _ in kept} == {str(i) for i, _ in firsts.values()}
    if name == "decontamination":
        assert kept == given
    if name == "mixing":
        assert set(kept) <= set(given) and all(n <= 3 * given[k] for k, n in kept.items())
