"""Best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most a sequence's capacity; how many there are of each length is a table of
at most ``capacity`` numbers, whatever the corpus, and packing needs no more than that. Where a small set of
lengths is as good for its longest piece as any other set, sequences of that set are fixed for good and the
instance shrinks; what remains goes, longest first, to the fullest sequence that has room. The plan says for each
length which sequence and offset the first, second, third... piece of it gets. Pieces learn their number among all of their length
from counts per task, so the text moves nowhere and the whole corpus is packed as one instance.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weekloom.session import stage

CAPACITY, END = 1024, 2
#: Pieces and ids of one batch that a task gives back.
BATCH_PIECES, BATCH_IDS = 4096, 1 << 20
#: A longer run of white space is too much for the fast encoder's pattern.
LONG_BLANK = re.compile(r"\s{2000}")
_encoders: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """Token ids of texts by a byte-level vocabulary; ``ranks`` is the same vocabulary as a list of ranks, which is faster to apply."""

    def __init__(self, path: str, ranks: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if LONG_BLANK.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def encoder(path: str, ranks: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]


@dataclass(frozen=True)
class Bins:
    """``count`` sequences alike; ``content`` lists (length, how many of it in each)."""

    content: tuple[tuple[int, int], ...]
    count: int


def _pattern(*lengths: int) -> tuple[tuple[int, int], ...]:
    return tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))


def _dominating(i: int, left: np.ndarray, capacity: int) -> tuple[int, ...] | None:
    """Lengths that go with one piece of length ``i`` in a set that dominates all others, or None where no set of at most three is known to.

    ``left`` holds the number of pieces of each length, with that one piece taken out.
    """
    room = capacity - i
    there = np.flatnonzero(left)
    if not len(there) or there[0] > room:
        return ()
    best = int(there[np.searchsorted(there, room, "right") - 1])
    if best == room:
        return (best,)
    small = np.repeat(there[:3], np.minimum(left[there[:3]], 3))[:3]
    if len(small) < 2 or small[:2].sum() > room:
        return (best,)
    if len(small) == 3 and small.sum() <= room:
        return None
    # at most two more fit: each shorter piece y with the longest x >= y beside it
    y = there[there <= room // 2]
    x = there[np.searchsorted(there, room - y, "right") - 1]
    real = (x > y) | (left[y] >= 2)
    x, y = x[real], y[real]
    if best >= (x + y).max():
        return (best,)
    # beside the longest piece, the longest second one; pairs that it doesn't cover piece by piece must fit into the longest alone
    with_best = y[x == best]
    if len(with_best) and not ((x + y)[y > with_best.max()] > best).any():
        return (best, int(with_best.max()))
    return None


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[Bins], np.ndarray]:
    """(fixed sequences, counts of what remains) for ``counts[n]`` pieces of length n.

    Longest pieces first, again and again until nothing more can be fixed; equal sets are fixed together.
    """
    left, fixed = counts.copy(), []
    changed = True
    while changed:
        changed = False
        for i in np.flatnonzero(left)[::-1].tolist():
            while left[i]:
                left[i] -= 1
                beside = _dominating(i, left, capacity)
                left[i] += 1
                if beside is None:
                    break
                taken = np.bincount([i, *beside], minlength=len(left))
                times = int((left[taken > 0] // taken[taken > 0]).min())
                # fixing a set only removes alternatives, so it dominates as long as its lengths last
                fixed.append(Bins(_pattern(i, *beside), times))
                left -= taken * times
                changed = True
    return fixed, left


def best_fit(counts: np.ndarray, capacity: int) -> list[Bins]:
    """Best-fit decreasing on counts: each piece, longest first, to the fullest sequence with room for it."""
    open_: dict[int, list[Bins]] = {}
    room = np.zeros(capacity + 1, np.int64)

    def put(bins: Bins, free: int) -> None:
        if bins.count:
            open_.setdefault(free, []).append(bins)
            room[free] += 1

    for n in np.flatnonzero(counts)[::-1].tolist():
        rest = int(counts[n])
        while rest:
            fitting = np.flatnonzero(room[n:])
            if len(fitting):
                free = n + int(fitting[0])
                bins = open_[free].pop()
                room[free] -= 1
            else:
                free, bins = capacity, Bins((), rest)
            each = free // n
            whole = min(bins.count, rest // each)
            put(Bins((*bins.content, (n, each)), whole), free - each * n)
            rest -= whole * each
            untouched = bins.count - whole
            if rest and untouched:  # fewer than ``each``
                put(Bins((*bins.content, (n, rest)), 1), free - rest * n)
                rest, untouched = 0, untouched - 1
            if bins.content:
                put(Bins(bins.content, untouched), free)
    return [b for found in open_.values() for b in found]


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go: rows by length, then first number; a piece finds its row by both.

    The r-th piece of the row's length, counted from ``first``, lies in sequence ``sequence + (r - first) // each`` at
    ``offset + (r - first) % each * length``.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # length and number as one key; lengths are below 2**13, numbers below 2**50
        at = np.searchsorted((self.length << 50) + self.first, (length.astype(np.int64) << 50) + number, "right") - 1
        within = number - self.first[at]
        return self.sequence[at] + within // self.each[at], self.offset[at] + within % self.each[at] * length


def plan(counts: np.ndarray, capacity: int) -> Slots:
    """The slots of ``counts[n]`` pieces of each length n up to ``capacity``; at most some thousand rows for a capacity of 1024."""
    fixed, left = reduce_by_dominance(counts, capacity)
    given, rows, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for bins in fixed + best_fit(left, capacity):
        offset = 0
        for n, each in bins.content:
            rows.append((n, int(given[n]), each, sequence, offset))
            given[n] += bins.count * each
            offset += n * each
        sequence += bins.count
    return Slots(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order: the first may be shorter, the others are full."""
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def tokenized_pieces(docs: DataFrame, tokenizer: str, ranks: str, capacity: int, end: int) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, place): pieces, and which of its length each is within its task."""
    last = np.array([end], "<u4")
    names = ["doc_id", "piece", "start", "length", "ids", "part", "place"]

    def batch_of(ids: list, rows: list) -> pa.RecordBatch:
        numbers = np.array([r[:-1] for r in rows], np.int64).reshape(-1, 5).T
        piece, start, length, part, place = (pa.array(c, pa.int64()) for c in numbers)
        data = pa.array([r[-1] for r in rows], pa.binary())
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), piece.cast(pa.int32()), start, length, data, part, place], names)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, ranks), TaskContext.get().partitionId()
        seen, ids, rows, held = np.zeros(capacity + 1, np.int64), [], [], 0
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                tokens = np.concatenate([encode.ids(text.as_py() or ""), last])
                start = 0
                for piece, n in enumerate(cut_lengths(len(tokens), capacity)):
                    ids.append(batch.column(0).slice(i, 1))
                    rows.append((piece, start, n, part, int(seen[n]), tokens[start : start + n].tobytes()))
                    seen[n] += 1
                    start += n
                    held += n
                    if len(rows) >= BATCH_PIECES or held >= BATCH_IDS:
                        yield batch_of(ids, rows)
                        ids, rows, held = [], [], 0
        if rows:
            yield batch_of(ids, rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids binary, part long, place long"
    return docs.select("doc_id", "text").mapInArrow(per_task, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    capacity: int = CAPACITY,
    end: int = END,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, the columns of ``keep`` (by default ``ids``), sequence_id, offset.

    Each document is its ids and ``end``; one of more than ``capacity`` ids is cut into full pieces after a shorter first one. ``ids`` are
    little-endian unsigned 32-bit numbers; ``keep`` names other columns computed from the piece before it is placed, so that only they are
    moved where the counts per task are too many to broadcast. ``tokenizer`` and ``ranks`` are paths of one vocabulary that
    every executor has. Null and empty texts have only the end id; very long texts are cut like others; rows that repeat are packed as often; a null
    doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    pieces = stage(tokenized_pieces(docs, tokenizer, ranks, capacity, end), "pieces")
    per_task = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # at most one row per length up to the capacity
    found = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in found.items():
        counts[length] = n
    slots = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select(F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = keep or {"ids": F.col("ids")}
    rows = pieces.select("doc_id", "piece", "start", "length", "part", "place", *[c.alias(name) for name, c in columns.items()])
    numbered = rows.join(stage(before, "piece-numbers"), (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
    numbered = numbered.select("doc_id", "piece", "start", "length", *columns, (F.col("before") + F.col("place")).alias("number"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            out = [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields[:-1])
    return numbered.mapInArrow(put, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of rows that ``pack`` gave with their ids: the pieces of each sequence, one after the other."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    return rows.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("length"), joined.alias("ids"))
