"""Ranked lexical search: the best documents of each query by the summed impact of its terms.

Each task makes shards of the documents it reads: posting lists of the queries' terms, documents in order of their ids. Over
the impacts of a shard's lists lies a range-maximum sparse table, which gives the greatest impact of a term among any
consecutive documents in two reads. A query's search holds intervals of documents, each bounded by the sum of its terms' maxima, and
goes on with the best: the document of the greatest single impact in it is scored, and what lies left and right of it become new intervals.
Intervals whose bound cannot reach the k-th best score so far are dropped, so the result is exact. The best k of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import word_blocks
from weekloom.session import stage

BEST = 10
#: Documents and occurrences of query terms at which a shard is closed (a shard has at least one document); documents have 16 bits.
SHARD_DOCUMENTS, SHARD_OCCURRENCES = 16_384, 1 << 22
#: Pairs of query and term that are searched in one go; more queries are searched block by block.
BLOCK_PAIRS = 4_000_000
#: Intervals that a search splits at once.
SPLIT = 64
#: Groups in which the shards' results are merged first.
MERGE_GROUPS = 64
#: Every byte that is part of a term, lower-cased if A-Z; all others are blanks.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c < 58 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_blocks(text: bytes) -> Iterator[list[bytes]]:
    return word_blocks(text.translate(_TERM_BYTES))


@dataclass(frozen=True)
class Queries:
    """A block of queries; each is a row of numbers of its distinct terms. Terms are numbered from 0, in order."""

    ids: pa.Array
    terms: list[bytes]
    rows: list[np.ndarray]


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, all their terms, and the documents that hold each query term."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(df) + 1))) for df in self.holding], np.int64)

    def length_part(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 90 + (90 * lengths * self.documents) // max(self.terms, 1)


def impacts(weights: np.ndarray, times: np.ndarray, length_part: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * times) // (1000 * times + 8 * length_part))


class RangeMaximum:
    """Where the greatest of ``values[a:b]`` stands, the first of equal ones, for many ranges at once."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        rows = [np.arange(len(values), dtype=np.int32)]
        while 2 ** len(rows) <= longest:
            half = 2 ** (len(rows) - 1)
            left, right = rows[-1][:-half], rows[-1][half:]
            rows.append(np.where(values[left] >= values[right], left, right))
        self.starts = np.cumsum([0] + [len(r) for r in rows])
        self.table = np.concatenate(rows)
        self.log = np.zeros(longest + 2, np.int8)
        for k in range(1, len(rows)):
            self.log[2**k :] = k

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(greatest value, its place); 0 and any place for an empty range."""
        full = b > a
        k = self.log[np.where(full, b - a, 1)].astype(np.int64)
        left = self.table[np.where(full, self.starts[k] + a, 0)]
        right = self.table[np.where(full, self.starts[k] + b - (1 << k), 0)]
        on_left = self.values[left] >= self.values[right]
        place = np.where(on_left, left, right)
        return np.where(full, self.values[place], 0), place


class Shard:
    """Posting lists of a shard: ``keys`` are term << 16 | document, in order."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, documents: int):
        self.keys, self.values, self.documents = keys, values, documents
        sizes = np.diff(np.flatnonzero(np.diff(keys >> 16, prepend=-1, append=-1))) if len(keys) else np.zeros(0)
        self.maximum = RangeMaximum(values, int(sizes.max()) if len(sizes) else 1)

    def best(self, terms: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(-score, document) of the k best documents with a score above 0, equal ones by number."""
        a, b = (np.searchsorted(self.keys, x << 16) for x in (terms, terms + 1))
        terms, a, b = terms[b > a, None], a[b > a, None], b[b > a, None]
        first = np.zeros(1, np.int64)
        bound = self.maximum.of(a, b)[0].sum(0)
        found: list[tuple[int, int]] = []
        while True:
            least, worst = (-found[-1][0], found[-1][1]) if len(found) == k else (0, -1)
            going = (bound > least) | ((bound == least) & (first < worst))
            if not going.all():
                a, b, first, bound = a[:, going], b[:, going], first[going], bound[going]
            if not len(bound):
                return found
            now = np.argpartition(-bound, SPLIT - 1)[:SPLIT] if len(bound) > SPLIT else np.arange(len(bound))
            later = np.ones(len(bound), bool)
            later[now] = False
            low, high = a[:, now], b[:, now]
            value, place = self.maximum.of(low, high)
            columns = np.arange(len(now))
            document = self.keys[place[value.argmax(0), columns]] & 0xFFFF
            key = (terms << 16) + document
            at = np.searchsorted(self.keys, key)
            held = (at < high) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key)
            score = np.where(held, self.values[np.minimum(at, len(self.keys) - 1)], 0).sum(0)
            found = sorted([*found, *zip((-score[score > 0]).tolist(), document[score > 0].tolist())])[:k]
            left_bound, right_bound = (self.maximum.of(*x)[0].sum(0) for x in ((low, at), (at + held, high)))
            a = np.concatenate([a[:, later], low, at + held], 1)
            b = np.concatenate([b[:, later], at, high], 1)
            bound = np.concatenate([bound[later], left_bound, right_bound])
            first = np.concatenate([first[later], first[now], document + 1])


_INDEX = "documents {}, lengths binary, keys binary, times binary, terms array<int>, holding array<int>, with_terms long, n_terms long"


def build_index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Shards (documents, lengths, keys, times, terms, holding, with_terms, n_terms), staged.

    ``documents`` are the ids in order, nulls first, ``lengths`` their numbers of terms; ``keys`` (term << 16 | document) and ``times`` are the
    postings, all as eight-byte numbers; ``terms`` and ``holding`` how many documents hold each term. Built by the tasks that read the documents, without a shuffle.
    """
    number = {t: i for i, t in enumerate(terms)}
    names = ["documents", "lengths", "keys", "times", "terms", "holding", "with_terms", "n_terms"]

    def shard(ids: pa.Array, lengths: list[int], words: list[np.ndarray]) -> pa.RecordBatch:
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        document = np.argsort(order, kind="stable")
        key = np.concatenate([w << 16 | d for w, d in zip(words, document.tolist())])
        keys, times = np.unique(key, return_counts=True)
        held, holding = np.unique(keys >> 16, return_counts=True)
        length = np.array(lengths, np.int64)
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
            *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (length[order], keys, times)],
            *[pa.array([x.tolist()], pa.list_(pa.int32())) for x in (held, holding)],
            *[pa.array([int(x)], pa.int64()) for x in ((length > 0).sum(), length.sum())],
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.get
        ids, lengths, words, held = [], [], [], 0
        for batch in batches:
            for i, data in enumerate(batch.column(1)):
                n, own = 0, []
                for block in term_blocks(data.as_py() or b""):
                    n += len(block)
                    own.append(np.fromiter((t for t in map(get, block) if t is not None), np.int64))
                ids.append(batch.column(0).slice(i, 1))
                lengths.append(n)
                words.append(np.concatenate(own) if own else np.zeros(0, np.int64))
                held += len(words[-1])
                if len(ids) >= SHARD_DOCUMENTS or held >= SHARD_OCCURRENCES:
                    yield shard(pa.concat_arrays(ids), lengths, words)
                    ids, lengths, words, held = [], [], [], 0
        if ids:
            yield shard(pa.concat_arrays(ids), lengths, words)

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    return stage(read.mapInArrow(per_task, _INDEX.format(f"array<{kind}>")), "postings")


def statistics(index: DataFrame, n_terms: int) -> Statistics:
    """Sums over all shards; one number comes to the driver for each query term."""
    total = index.agg(F.sum("with_terms"), F.sum("n_terms")).first()
    held = index.select(F.explode(F.arrays_zip("terms", "holding")).alias("x")).groupBy("x.terms").agg(F.sum("x.holding").alias("n"))
    holding = np.zeros(n_terms, np.int64)
    for row in held.collect():
        holding[row["terms"]] = row["n"]
    return Statistics(total[0] or 0, total[1] or 0, holding)


def search(index: DataFrame, queries: Queries, known: Statistics, k: int) -> DataFrame:
    """(query, item_id, doc_id, score, part): the k best documents of each shard; ``query`` is a number, ``part`` a group of shards."""
    weights, rows, ids = known.weights(), queries.rows, queries.ids
    names = ["query", "item_id", "doc_id", "score", "part"]

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                lengths, keys, times = (np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in (1, 2, 3))
                values = impacts(weights[keys >> 16], times, known.length_part(lengths)[keys & 0xFFFF])
                shard = Shard(keys, values, len(lengths))
                found = [(q, -score, d) for q, terms in enumerate(rows) for score, d in shard.best(terms, k)] if len(keys) else []
                query, score, document = (pa.array(x, pa.int64()) for x in (zip(*found) if found else ([], [], [])))
                part = pa.array([batch.column(4)[r].as_py()] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([query, ids.take(query), batch.column(0)[r].values.take(document), score, part], names)

    kind = index.schema["documents"].dataType.elementType.simpleString()
    part = F.pmod(F.xxhash64("documents"), F.lit(MERGE_GROUPS)).alias("part")
    schema = f"query long, item_id {_spark_type(ids.type)}, doc_id {kind}, score long, part long"
    return index.select("documents", "lengths", "keys", "times", part).mapInArrow(per_batch, schema)


def _spark_type(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind).simpleString()


def query_blocks(benchmark: DataFrame) -> Iterator[Queries]:
    """The distinct queries (item_id, text) in blocks of about ``BLOCK_PAIRS`` pairs of query and term."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({t for block in term_blocks(x.as_py() or b"") for t in block}) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    read = benchmark.select("item_id", F.col("text").cast("binary").alias("data")).distinct()
    items = stage(read.mapInArrow(per_batch, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0), "queries")
    pairs = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = 1 + pairs // BLOCK_PAIRS
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b).toArrow()
        if len(block):
            found = [[bytes(t) for t in x] for x in block["terms"].to_pylist()]
            terms = sorted({t for x in found for t in x})
            number = {t: i for i, t in enumerate(terms)}
            rows = [np.array([number[t] for t in x], np.int64) for x in found]
            yield Queries(block["item_id"].combine_chunks(), terms, rows)


def rank(docs: DataFrame, benchmark: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): of each row of ``benchmark`` the k best rows of ``docs`` with a score above 0, rank from 1.

    Equal scores are ordered by doc_id, nulls first. Null and empty texts have no terms: as queries they find nothing, as documents they are
    found by none and don't count. Repeated documents are ranked one by one; a repeated (item_id, text) is one query, other texts of the
    same item_id are queries of their own. Very long texts are read whole, block by block. Other columns are ignored; with an empty table on either side there are no rows.
    """
    found = None
    for queries in query_blocks(benchmark):
        index = build_index(docs, queries.terms)
        part = merged(search(index, queries, statistics(index, len(queries.terms)), k), k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        ids = [x.schema[c] for x, c in ((benchmark, "item_id"), (docs, "doc_id"))]
        kinds = [f.dataType.simpleString() for f in ids]
        return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return found


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, first within each group of shards, so that no task gets more than its share."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    within = F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    first = found.withColumn("rank", within).where(F.col("rank") <= k)
    best = first.withColumn("rank", place).where(F.col("rank") <= k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
