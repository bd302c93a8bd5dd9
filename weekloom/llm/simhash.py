"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits. Two fingerprints link if at most ``BUDGET`` (2) bits differ. Cut into
three segments on a ring, such a pair has a segment from which every chain of consecutive segments
stays within its share of the budget: 2/3, 4/3 and 2 bits, so 0, 1 and 2. The first segment of the
chain is thus equal, and one half of the second is equal too; these 32 bits or so are the join key.
The chain over two segments is checked next, the full distance last. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import components, word_blocks
from weekloom.session import stage

BUDGET = 2
SHINGLE = 3
SEED = 42
#: (first bit, number of bits) of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased words of a text: a bit is set if over half the shingle hashes have it."""
    counts, total, tail, words = np.zeros(64, np.int64), 0, [], []
    for block in word_blocks(data.lower()):
        words = tail + block
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(shingle - 1) :]
    if not total and words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``; null and empty texts have fingerprint zero."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py() or b"", shingle) for x in batch.column(2)]
            fps = pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "text_key", "fp"])

    read = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(per_batch, f"doc_id {kind}, text_key long, fp long")


def _bits(fp: Column, first: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _mask(*segments: tuple[int, int]) -> Column:
    value = sum(((1 << n) - 1) << first for first, n in segments)
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def linked_fingerprints(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different values of ``fp`` at most ``BUDGET`` bits apart, each once, with a < b."""
    keys = []
    for i, (first, n) in enumerate(SEGMENTS):
        start, width = SEGMENTS[(i + 1) % len(SEGMENTS)]
        cut = width // 2
        for half, (at, size) in enumerate(((start, cut), (start + cut, width - cut))):
            key = F.shiftleft(_bits(F.col("fp"), first, n), size).bitwiseOR(_bits(F.col("fp"), at, size))
            keys.append(F.struct(F.lit(2 * i + half).alias("table"), key.alias("key")))
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.table", "k.key")
    diff = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    chain = F.lit(False)
    for i, segment in enumerate(SEGMENTS):
        mask = _mask(segment, SEGMENTS[(i + 1) % len(SEGMENTS)])
        chain = chain | ((F.floor(F.col("l.table") / 2) == i) & (F.bit_count(diff.bitwiseAND(mask)) <= 1))
    same = (F.col("l.table") == F.col("r.table")) & (F.col("l.key") == F.col("r.key"))
    near = keyed.alias("l").join(
        keyed.alias("r"), same & (F.col("l.fp") < F.col("r.fp")) & chain & (F.bit_count(diff) <= BUDGET)
    )
    return near.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).distinct()


def classed(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) per row of ``docs``.

    ``component`` is the least fingerprint reachable over links, itself included, and never null;
    ``component_id`` is the smallest doc_id in it. Rows with the same fingerprint are one node, so a
    group of copies costs one row however large it is.
    """
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("node"))
    reached = components(linked_fingerprints(nodes.select("fp")))
    members = nodes.join(reached, nodes["fp"] == reached["node"], "left").select(
        nodes["fp"], nodes["node"].alias("first"), F.coalesce("component", nodes["fp"]).alias("component")
    )
    smallest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stage(members.join(smallest, "component").select("fp", "component", "component_id"), "classes")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, itself included. A null doc_id takes
    part, but only names a component in which all ids are null. Repeated rows and ties share a
    component. Other columns are ignored; an empty table gives no rows.
    """
    return classed(docs, shingle).drop("component")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each group of near-duplicates.

    The row with the smallest doc_id stays, one without an id only where all lack it (of several with
    that id, the one with the smallest hash of its text; of repeated rows, one). Rows of different
    groups never stand for each other, also if their ids are null or equal.
    """
    found = stage(classed(docs).select("doc_id", "text_key", "component"), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"))
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"))
    out = packed.join(kept, packed["d"].eqNullSafe(kept["doc_id"]) & (packed["t"] == kept["text_key"]), "left_semi")
    repeated = found.groupBy("doc_id", "text_key").count().agg(F.max("count")).first()[0] or 0
    if repeated > 1:
        out = out.dropDuplicates(["d", "t"])
    return out.select("row.*")
