"""Ranked search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weekloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_rank(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    total, n_docs = sum(sum(c.values()) for _, c in counts), sum(bool(c) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(total, 1)
            weigh = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weigh(t) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, r, d, -score) for r, (score, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def ranked(docs, items, k=10):
    return sorted((tuple(r) for r in ranked_search.rank(docs, items, k).collect()), key=str)


def test_range_maximum_is_the_first_greatest():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 8, 100):
        values = rng.integers(1, 9, n)
        table = ranked_search.RangeMaximum(values, n)
        a, b = np.array([(i, j) for i in range(n + 1) for j in range(i, n + 1)]).T
        value, place = table.of(a, b)
        for i, j, v, p in zip(a, b, value, place):
            assert v == (values[i:j].max() if j > i else 0) and (j == i or p == i + values[i:j].argmax())


def test_best_first_search_equals_scoring_all():
    rng = np.random.default_rng(3)
    for _ in range(60):
        documents, n_terms = int(rng.integers(1, 400)), 12
        keys = np.unique(rng.integers(0, n_terms, 900) << 16 | rng.integers(0, documents, 900))
        values = rng.integers(0, 7, len(keys))
        shard = ranked_search.Shard(keys, values, documents)
        query = np.sort(rng.choice(n_terms + 3, 6, replace=False))
        score = np.zeros(documents, int)
        for t in query:
            mine = keys >> 16 == t
            score[keys[mine] & 0xFFFF] += values[mine]
        expected = sorted((-int(s), d) for d, s in enumerate(score) if s)[:10]
        assert shard.best(query, 10) == expected


def test_search_opens_few_documents():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 30, 200_000) << 16 | rng.integers(0, 16_000, 200_000))
    values = rng.integers(1, 100, len(keys)) ** 3
    shard = ranked_search.Shard(keys, values, 16_000)
    opened = []
    whole = shard.maximum.of
    shard.maximum.of = lambda a, b: opened.append(a.shape[-1]) or whole(a, b)
    shard.best(np.arange(5), 10)
    assert sum(opened) / 3 < 4_000


def test_odd_documents_and_queries(spark, odd, monkeypatch):
    items = [(1, "The QUICK brown fox, the fox"), (2, "alpha gamma"), (None, "dog id"), (3, ""), (4, None), (5, "nowhere"), (1, "The QUICK brown fox, the fox"), (1, "again"), (6, "ßtraße ÉÀ 漢字 7 1")]
    benchmark = spark.createDataFrame([(*i, "x", 3) for i in items], "item_id long, text string, terms string, query int")
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    expected = plain_rank(rows, sorted(set(items), key=str), 3)
    assert ranked(odd, benchmark, 3) == expected
    monkeypatch.setattr(ranked_search, "BLOCK_PAIRS", 4)
    assert ranked(odd, benchmark, 3) == expected
    assert ranked(odd.limit(0), benchmark) == ranked(odd, benchmark.limit(0)) == []
    assert ranked_search.rank(odd, benchmark.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_many_copies_and_ties_over_several_shards(spark):
    docs = spark.range(900).select((F.col("id") * 37 % 900).alias("doc_id"), F.when(F.col("id") % 3 == 0, "one two three").when(F.col("id") % 3 == 1, "two three four four").otherwise("none at all").alias("text"))
    items = spark.createDataFrame([(1, "two"), (2, "one four"), (3, "three none")], "item_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    assert ranked(docs.repartition(7), items) == plain_rank(rows, [tuple(r) for r in items.collect()])
