"""Packing by dominance and best fit: against the tokenizer, and against the least number of sequences."""

import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from weekloom.llm import best_fit
from weekloom.llm.queries import QUERIES

from .conftest import FOLDER

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def counted(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1) if len(lengths) else np.zeros(capacity + 1, np.int64)


def least_bins(lengths, capacity):
    """The least number of bins, by trying every set for the longest piece."""

    @cache
    def of(items):
        if not items:
            return 0
        first, rest = items[0], items[1:]
        found = set()

        def grow(k, room, left, taken):
            found.add(left + rest[k:] if k <= len(rest) else left)
            for j in range(k, len(rest)):
                if rest[j] <= room and (j == k or rest[j] != rest[j - 1]):
                    grow(j + 1, room - rest[j], left + rest[k:j], taken + 1)

        grow(0, capacity - first, (), 0)
        return 1 + min(of(tuple(sorted(x, reverse=True))) for x in found)

    return of(tuple(sorted(lengths, reverse=True)))


def test_reduction_keeps_the_least_number_of_sequences():
    rng = random.Random(4)
    reduced = 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 37])
        lengths = [rng.randint(rng.choice([1, capacity // 4, capacity // 3]) or 1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, left = best_fit.reduce_by_dominance(counted(lengths, capacity), capacity)
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        assert sum(b.count for b in fixed) + least_bins(rest, capacity) == least_bins(lengths, capacity), (capacity, lengths)
        reduced += len(lengths) - len(rest)
    assert reduced > 1500


def test_dominating_sets_of_three():
    # 5 beside 3 and 2 covers 2 and 2; beside 3 and 1, 2 and 2 would not be covered
    assert best_fit._dominating(5, counted([3, 2, 2], 10), 10) == (3, 2)
    assert best_fit._dominating(10, counted([6, 5, 5, 4], 20), 20) is None
    assert best_fit._dominating(5, counted([3, 1, 1, 1], 10), 10) is None
    assert best_fit._dominating(6, counted([4, 2], 10), 10) == (4,)
    assert best_fit._dominating(6, counted([5], 10), 10) == ()


def test_best_fit_holds_every_piece_once_and_puts_it_where_it_fits_best():
    rng = np.random.default_rng(2)
    for capacity in (8, 64, 1024):
        lengths = rng.integers(1, capacity + 1, 700)
        bins = best_fit.best_fit(counted(lengths, capacity), capacity)
        held = np.zeros(capacity + 1, np.int64)
        for b in bins:
            assert b.count and sum(n * k for n, k in b.content) <= capacity
            for n, k in b.content:
                held[n] += k * b.count
        assert (held == counted(lengths, capacity)).all()
        one_by_one = []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [i for i, room in enumerate(one_by_one) if room >= n]
            if fits:
                one_by_one[min(fits, key=lambda i: one_by_one[i])] -= n
            else:
                one_by_one.append(capacity - n)
        assert sorted(one_by_one) == sorted(r for b in bins for r in [capacity - sum(n * k for n, k in b.content)] * b.count)


def check(pieces, texts):
    """pieces with ids_crc32; texts: (doc_id, text) pairs."""
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    expected = []
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        start = 0
        for k, n in enumerate(best_fit.cut_lengths(len(ids), 1024)):
            expected.append((str(doc), k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())))
            start += n
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces) == sorted(expected)
    fills = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills.get(r["sequence_id"], 0)
        fills[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 1024 for n in fills.values())
    least = -(-sum(fills.values()) // 1024)
    return len(fills), least


def test_packing_of_a_whole_table(tables):
    docs = [(r["doc_id"], r["text"]) for r in tables("documents").select("doc_id", "text").collect()]
    found = QUERIES["op13_best_fit_packing"](tables("documents").sparkSession, FOLDER).collect()
    used, least = check([r.asDict() for r in found], docs)
    assert used <= 1.02 * least + 1


def test_packing_of_odd_rows(spark, odd):
    extra = [(20, "x" + " " * 300_000 + "y"), (21, "<|endoftext|> it's  　 so"), (22, "a" * 100_000)]
    docs = odd.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    packed = best_fit.pack(docs, *PATHS).collect()
    pieces = [r.asDict() | {"ids_crc32": zlib.crc32(bytes(r["ids"]))} for r in packed]
    check(pieces, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert best_fit.pack(odd.limit(0), *PATHS).count() == 0


def test_sequences_hold_their_pieces_in_order(spark, tables):
    packed = best_fit.pack(tables("documents"), *PATHS)
    expected = {}
    for r in sorted(packed.collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        expected[r["sequence_id"]] = expected.get(r["sequence_id"], b"") + bytes(r["ids"])
    found = {r["sequence_id"]: bytes(r["ids"]) for r in best_fit.sequences(packed).collect()}
    assert found == expected and all(len(v) <= 4096 for v in found.values())
