from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstline.llm import bm25


def brute(queries, rows, k, query_terms=None):
    """Every document scored for every query."""
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    docs = [(i, Counter(split(t)), len(split(t))) for i, t in rows]
    mean = max(sum(n for _, _, n in docs), 1) / max(len(docs), 1)
    df = Counter(w for _, tf, _ in docs for w in tf)
    idf = {w: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    asked = {}
    for i, t in queries:
        if i is not None:
            asked.setdefault(i, Counter()).update(split(t))
    out = []
    for query, words in asked.items():
        known = sorted((w for w in words if w in idf), key=lambda w: (-round(words[w] * idf[w], 9), w.encode()))
        scores = []
        for i, tf, n in docs:
            common = [w for w in known[:query_terms] if w in tf]
            if i is not None and common:
                s = sum(
                    idf[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w in common
                )
                scores.append((-round(s, 6), i))
        out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def planted():
    rng, rows = random.Random(8), []
    for k in range(300):
        words = [f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(rng.randrange(1, 60))]
        rows.append((k * 7, " ".join(words)))
    rows += [(5000 + k, rows[3][1]) for k in range(15)] + [(0, rows[0][1])]
    rows += [(6000, None), (6001, ""), (6002, "É é Wörd"), (None, "w1 w2 w3"), (6003, "w1 " * 3000)]
    return rows


@pytest.mark.parametrize("query_terms, k", [(None, 10), (5, 10), (32, 1), (3, 50)])
def test_equals_brute_force(spark, monkeypatch, query_terms, k):
    monkeypatch.setattr(bm25, "BYTES_PER_SHARD", 6000)
    monkeypatch.setattr(bm25, "BLOCK", 4)
    rows = planted()
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0] + [(1, "unknown W1\tw2")]
    make = lambda x: spark.createDataFrame(x, "doc_id long, text string").repartition(3)
    frame = make(rows)
    out = bm25.search(make(queries), frame.withColumn("score", frame.text), k, query_terms)
    assert out.columns == ["query_id", "rank", "doc_id", "score"]
    got = sorted((q, r, i, round(s, 6)) for q, r, i, s in map(tuple, out.collect()))
    truth = brute(queries, rows, k, query_terms)
    assert [x[:3] for x in got] == [x[:3] for x in truth]
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, truth))


def test_lists_of_frequent_words_are_passed_over():
    texts = [b"common " * 3 + (b"rare " * 5 if k % 70 == 0 else b"") + b"x%d" % k for k in range(7000)]
    index = bm25.Index(np.arange(7000), texts, 4.0)
    _, lists = index.known(bm25.word_hashes(b"common rare"))
    hits = index.top(lists, np.array([0.001, 4.0]), 5)
    assert [doc for _, doc in hits] == [0, 70, 140, 210, 280]
    assert index.asked == 7100 and index.touched < 400
    assert not index.weight.any()


@pytest.mark.parametrize("words", [3, 12, 60])
def test_pruning_is_exact(words, monkeypatch):
    monkeypatch.setattr(bm25, "SEED_POSTINGS", 50)
    rng = np.random.default_rng(words)
    # Topics share frequent words and have some of their own.
    texts = []
    for k in range(3000):
        frequent = np.minimum(rng.zipf(1.4, rng.integers(1, 80)), 300)
        own = 1000 + 40 * (k % 50) + rng.integers(0, 40, 10)
        texts.append(b" ".join(b"w%d" % w for w in [*frequent, *own]))
    mean = float(np.mean([len(t.split()) for t in texts]))
    index = bm25.Index(np.arange(3000), texts, mean)
    df = np.diff(index.first)
    idf = np.log(1 + (3000 - df + 0.5) / (df + 0.5))
    for k in range(0, 3000, 100):
        asked = np.unique(bm25.word_hashes(texts[k]))[:words]
        _, lists = index.known(asked)
        scores = np.round(index._partial(lists, idf[lists]), bm25.DECIMALS)
        index.touched = index.touched - int(df[lists].sum())
        order = np.lexsort((np.arange(3000), -scores))[:10]
        expected = [(scores[d], d) for d in order if scores[d] > 0]
        found = index.top(lists, idf[lists], 10)
        assert [d for _, d in found] == [d for _, d in expected]
        assert np.allclose([s for s, _ in found], [s for s, _ in expected], atol=2e-6)
    assert index.touched < (0.3 if words < 60 else 0.6) * index.asked


def zipf_texts(rows, seed):
    rng = np.random.default_rng(seed)
    frequent = [np.minimum(rng.zipf(1.25, rng.integers(20, 120)), 5000) for _ in range(rows)]
    return [b" ".join(b"w%d" % w for w in words) for words in frequent]


def asked_by(index, texts, step):
    idf = np.log(1 + (len(texts) - np.diff(index.first) + 0.5) / (np.diff(index.first) + 0.5))
    lists = [index.known(np.unique(bm25.word_hashes(t)))[1] for t in texts[::step]]
    return [(some, idf[some]) for some in lists]


def test_whole_texts_touch_few_postings():
    texts = zipf_texts(4000, 1)
    index = bm25.Index(np.arange(4000), texts, float(np.mean([len(t.split()) for t in texts])))
    for lists, weights in asked_by(index, texts, 50):
        index.top(lists, weights, 10)
    assert index.touched < 0.25 * index.asked


@pytest.mark.parametrize("rows_bytes, product_bytes", [(48 << 20, 16 << 20), (4 * 700 * 3, 1), (0, 9000)])
def test_queries_taken_together_are_exact(monkeypatch, rows_bytes, product_bytes):
    monkeypatch.setattr(bm25, "FREQUENT_BYTES", rows_bytes)
    monkeypatch.setattr(bm25, "PRODUCT_BYTES", product_bytes)
    monkeypatch.setattr(bm25, "SEED_POSTINGS", 20)
    texts = zipf_texts(600, 2)
    texts += [texts[5]] * 30 + [b"", None] + [b"w1 " * 9] * 68
    index = bm25.Index(np.arange(700), texts, float(np.mean([len((t or b"").split()) for t in texts])))
    assert len(index.rows) <= rows_bytes // (4 * 700) and (len(index.rows) > 3) == (rows_bytes > 1 << 20)
    asked = asked_by(index, texts[:600], 5)
    for (lists, weights), found in zip(asked, index.tops(asked, 10), strict=True):
        scores = np.round(index._partial(lists, weights), bm25.DECIMALS)
        order = np.lexsort((np.arange(700), -scores))[:10]
        assert [d for _, d in found] == [d for d in order if scores[d] > 0]
        assert np.allclose([s for s, _ in found], scores[[d for _, d in found]], atol=2e-6)
    assert not index.weight.any() and not index.wanted.any()


def test_products_are_bounds():
    texts = zipf_texts(500, 3)
    index = bm25.Index(np.arange(500), texts, 70.0)
    for lists, weights in asked_by(index, texts, 25):
        frequent = index.row[lists] >= 0
        factors = np.zeros((1, len(index.rows)), np.float32)
        factors[0, index.row[lists[frequent]]] = weights[frequent]
        most = (factors @ index.rows * index.above)[0]
        exact = index._partial(lists[frequent], weights[frequent])
        assert (most >= exact).all() and np.allclose(most, exact, rtol=1e-3)


def test_no_documents_and_no_words():
    assert bm25.Index(np.zeros(0, np.int64), [], 1.0).known(np.arange(3).astype(np.uint64))[0].sum() == 0
    index = bm25.Index(np.arange(2), [None, b""], 1.0)
    assert not index.known(bm25.word_hashes(b"a"))[0].any()


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert bm25.search(some.limit(0), some).count() == 0
    assert bm25.search(some, some.limit(0)).count() == 0
    assert bm25.search(some, some).count() == 1


def test_registered_query_asks_all_words(spark, tables):
    from burstline.llm.queries import op5_bm25

    documents = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert max(len(set((t or "").lower().split())) for _, t in queries) > 32
    got = sorted((q, r, i, round(s, 6)) for q, r, i, s in map(tuple, op5_bm25(spark, tables).collect()))
    truth = brute(queries, rows, 10)
    assert [x[:3] for x in got] == [x[:3] for x in truth]
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, truth))


def test_a_shard_answers_as_it_reads_queries():
    index = bm25.Index(np.arange(3), [b"a b", b"b", b"c"], 1.0)
    terms, read = np.sort(bm25.word_hashes(b"b unknown")), []
    queries = ((read.append(k) or k, terms, np.ones(2)) for k in range(10 * bm25.QUERIES_AT_ONCE))
    first, *others = bm25._answered(index, queries, 2)
    assert first.num_rows == bm25.QUERIES_AT_ONCE and len(others) == 10
    assert [h["doc_id"] for h in first.column("hits")[0].as_py()] == [1, 0]
    read.clear()
    queries = ((read.append(k) or k, terms, np.ones(2)) for k in range(10 * bm25.QUERIES_AT_ONCE))
    next(bm25._answered(index, queries, 2))
    assert len(read) == bm25.QUERIES_AT_ONCE


def test_a_task_has_one_shard_and_no_queries(spark):
    rows = [(k, b"a", k % 13) for k in range(130)]
    frame = spark.createDataFrame(rows, "doc_id long, text binary, shard long")
    plan = bm25._searched(frame, 13, "unused", 1.0, 2)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan
    dealt = frame.repartitionById(13, frame.shard.cast("int"))
    shards = dealt.groupBy(F.spark_partition_id()).agg(F.count_distinct("shard")).collect()
    assert len(shards) == 13 and {r[1] for r in shards} == {1}


def test_a_text_of_several_megabytes(spark):
    long = " ".join(f"w{k % 50_000}" for k in range(400_000))
    rows = [(0, long), (50, "w1 w2 w3"), (51, "w3 w4"), (52, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = bm25.search(frame.filter("doc_id IN (0, 50)"), frame, 10)
    got = sorted((q, r, i, round(s, 6)) for q, r, i, s in map(tuple, out.collect()))
    truth = brute(rows[:2], rows, 10)
    assert [x[:3] for x in got] == [x[:3] for x in truth] and len(got) == 6


def languages(rows, seed):
    """Texts of two languages that share some words, short and long ones."""
    rng, texts = np.random.default_rng(seed), []
    for k in range(rows):
        words = np.minimum(rng.zipf(1.3, rng.integers(5, 400 if k % 9 == 0 else 60)), 3000)
        shared = rng.random(len(words)) < 0.1
        texts.append(b" ".join(b"%c%d" % (b"s" if s else b"ab"[k % 2 : k % 2 + 1], w) for w, s in zip(words, shared)))
    return texts


def shard_of(texts, ids=None):
    terms, counts, lengths = (list(x) for x in zip(*map(bm25._counted, texts)))
    mean = float(np.mean(lengths))
    return bm25.Shard.of(np.arange(len(texts)) if ids is None else ids, terms, counts, lengths, mean)


def known_by(shard, texts):
    terms = [np.unique(bm25.word_hashes(t)) for t in texts]
    return shard.known(terms, [1 + (t % np.uint64(97)).astype(np.float64) / 9 for t in terms])


def scored(shard, asked, n):
    """Scores and ids of all documents for a query, best first."""
    scores = [np.round(x._partial(*own[n]), bm25.DECIMALS) for x, own in zip(shard.indexes, asked)]
    scores, ids = np.concatenate(scores), np.concatenate([x.ids for x in shard.indexes])
    order = np.lexsort((ids, -scores))
    return [(scores[d], ids[d]) for d in order if scores[d] > 0]


def test_languages_are_kinds(monkeypatch):
    monkeypatch.setattr(bm25, "LEAST_KIND", 100)
    shard = shard_of(languages(2000, 4))
    assert len(shard.indexes) > 1
    assert all(len(set((x.ids % 2).tolist())) == 1 or len(x.ids) < 400 for x in shard.indexes)
    assert sorted(np.concatenate([x.ids for x in shard.indexes]).tolist()) == list(range(2000))


def test_kinds_of_one_shard_answer_as_one_index(monkeypatch):
    monkeypatch.setattr(bm25, "LEAST_KIND", 100)
    monkeypatch.setattr(bm25, "SEED_POSTINGS", 100)
    texts = languages(1500, 5)
    texts += [texts[3]] * 20 + [b"", None] + [b"s1 " * 9] * 30
    ids = np.random.default_rng(5).permutation(len(texts)) // 2  # some share an id
    shard = shard_of(texts, ids)
    assert len(shard.indexes) > 1
    asked = known_by(shard, [*texts[:300:7], b"unknown", b""])
    found = list(shard.tops(asked, [-math.inf] * 45, 10))
    for n, hits in enumerate(found):
        expected = scored(shard, asked, n)[:10]
        assert [d for _, d in hits] == [d for _, d in expected]
        assert np.allclose([s for s, _ in hits], [s for s, _ in expected], atol=2e-6)
    assert found[-2:] == [[], []]


def test_documents_below_a_threshold_are_not_scored():
    texts = languages(1200, 6)
    shard = shard_of(texts)
    asked = known_by(shard, texts[:40])
    every = [scored(shard, asked, n) for n in range(40)]
    calls = []
    for index in shard.indexes:
        index.scores = lambda *x, own=index.scores: calls.append(len(x[2])) or own(*x)
    # As far as the fourth, and with equal ones; and nothing.
    for place, most in ((3, 14), (0, 2)):
        calls.clear()
        found = list(shard.tops(asked, [hits[place][0] for hits in every], 10))
        for hits, expected in zip(found, every):
            reach = [x for x in expected if x[0] >= expected[place][0] - 2e-6][:10]
            assert [d for _, d in hits] == [d for _, d in reach]
        assert sum(calls) <= 40 * most
    calls.clear()
    assert list(shard.tops(asked, [hits[0][0] + 1 for hits in every], 10)) == [[]] * 40 and not calls


def test_shards_asked_later_know_a_threshold(spark, monkeypatch):
    monkeypatch.setattr(bm25, "BYTES_PER_SHARD", 1500)
    stored, store = {}, bm25.Scratch.store

    def kept(self, frame, name):
        stored[name] = store(self, frame, name)
        if name in ("first", "found"):
            stored[name] = [len(r.hits) for r in stored[name].collect()]
            return store(self, spark.read.parquet(self.path(name)), f"{name} again")
        return stored[name]

    monkeypatch.setattr(bm25.Scratch, "store", kept)
    rows = planted()
    queries = [r for r in rows if r[0] is not None and r[0] % 35 == 0]
    make = lambda x: spark.createDataFrame(x, "doc_id long, text string").repartition(3)
    out = bm25.search(make(queries), make(rows), 3)
    got = sorted((q, r, i, round(s, 6)) for q, r, i, s in map(tuple, out.collect()))
    truth = brute(queries, rows, 3)
    assert [x[:3] for x in got] == [x[:3] for x in truth]
    # Without a threshold, these would be as many a shard as in the first ones, over seven times as many.
    assert len(stored["first"]) and sum(stored["found"]) < 4.5 * sum(stored["first"])


def test_a_threshold_is_of_all_shards_asked(spark):
    hits = "query_id long, hits array<struct<score:double,doc_id:long>>"
    rows = [(1, [(9.0, 1), (5.0, 2)]), (1, [(8.0, 3), (7.0, 4)]), (2, [(3.0, 1)]), (3, [(2.0, 1)]), (3, [(2.0, 5)])]
    least = bm25._least(spark.createDataFrame(rows, hits), 2)
    assert sorted(map(tuple, least.collect())) == [(1, 8.0), (2, 0.0), (3, 2.0)]
