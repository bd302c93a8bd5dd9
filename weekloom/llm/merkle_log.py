"""Merkle manifest of a dataset as a postorder append log.

Rows are leaves of one tree per language, whose roots are the leaves of the dataset's tree; each node is the hash of up to ``ARITY``
children. Builders take aligned blocks of consecutive leaves and append every node when it is
complete, that is right behind its last child. So a node's place in the log follows from sizes of subtrees alone, and
a proof reads its siblings from computed places. The roots of blocks are the leaves of the next tier of builders, until one block is left.
Nothing larger than a block is ever in one place, and there are as many tiers as the logarithm of the rows to the base of a block's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.session import stage

ARITY = 8
#: Levels of a block, so of ``ARITY`` to that power leaves.
BLOCK_LEVELS = 3
#: Hexadecimal digits of a digest.
WIDTH = 64
#: Rows of one batch of proofs.
BATCH = 1024


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    """``-`` for null, else the bytes of the value as text, a colon, and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The leaf of a row of ``documents`` whose text is ``text``."""
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256)


# -- places in the log -------------------------------------------------------------------------


def levels(n: int) -> int:
    """Levels above the leaves in a tree of n of them."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


def subtree(width: int, level: int) -> int:
    """Nodes of a subtree of that level over ``width`` leaves."""
    return sum(-(-width // ARITY**k) for k in range(level + 1))


def position(level: int, index: int, n: int, top: int) -> int:
    """Where the node stands in a log of n leaves and ``top`` levels: behind all complete before its first leaf, last of its subtree."""
    first = index * ARITY**level
    before = sum(first // ARITY**k for k in range(top + 1))
    return before + subtree(min(ARITY**level, n - first), level) - 1


def append_log(leaves: list[str], top: int) -> list[str]:
    """All nodes over ``leaves`` up to level ``top``, in the order in which they are complete."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(top + 1)]
    for j, node in enumerate(leaves, 1):
        log.append(node)
        waiting[0].append(node)
        for k in range(1, top + 1):
            if j % ARITY**k and j < len(leaves):
                break
            node = digest("".join(waiting[k - 1]))
            waiting[k - 1].clear()
            waiting[k].append(node)
            log.append(node)
    return log


def block_shape(block: int, n: int, block_levels: int) -> tuple[int, int]:
    """(leaves, levels) of a block of a tree of n leaves."""
    size = ARITY**block_levels
    return min(size, n - block * size), min(block_levels, levels(n))


class Siblings:
    """Siblings within a block, read from its log."""

    def __init__(self, log: str, block: int, n: int, block_levels: int):
        self.n, self.top = block_shape(block, n, block_levels)
        self.runs = []
        for k in range(self.top):
            count = -(-self.n // ARITY**k)
            nodes = [log[WIDTH * p : WIDTH * (p + 1)] for p in (position(k, j, self.n, self.top) for j in range(count))]
            self.runs.append(["".join(nodes[j : j + ARITY]) for j in range(0, count, ARITY)])

    def of(self, index: int) -> str:
        """Of the leaf with that index in the block: level by level, left to right."""
        out = []
        for runs in self.runs:
            run, place = divmod(index, ARITY)
            out += (runs[run][: WIDTH * place], runs[run][WIDTH * (place + 1) :])
            index = run
        return "".join(out)


def fold(node: str, proof: str, *places: tuple[int, int]) -> str:
    """The root that ``node`` and its proof lead to, through trees where it is leaf (index, of so many)."""
    at = 0
    for index, n in places:
        while n > 1:
            run, place = divmod(index, ARITY)
            others = min(ARITY, n - run * ARITY) - 1
            middle, end = at + WIDTH * place, at + WIDTH * others
            node = digest(proof[at:middle] + node + proof[middle:end])
            at, index, n = end, run, -(-n // ARITY)
    return node


# -- tables ------------------------------------------------------------------------------------


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with i, their place (from 0) in their ``tree`` by ``order``, and n, how many the tree has.

    A sort over all rows; each of its parts then counts what lies in front of it. No tree goes through one task.
    """
    placed = stage(rows.orderBy("tree", *order).withColumn("row", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("part", F.shiftright("row", 33))
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")
    parts = stage(parts.select("tree", "part", before.alias("shift"), F.sum("here").over(tree).alias("n")), "tree-parts")
    return placed.join(parts, ["tree", "part"]).select(*rows.columns, (F.col("row") + F.col("shift")).alias("i"), "n")


def build(nodes: DataFrame, carried: tuple[str, ...], block_levels: int) -> list[DataFrame]:
    """Tiers of segments (tree, block, n, members, log, digest) over the leaves (tree, i, n, digest) of trees.

    ``members`` are the block's leaves (i, digest, ``carried``) in order, ``log`` the text of its nodes one after the other, the last
    of which is its root, ``digest``. A tree has as many tiers as it needs.
    """

    size = ARITY**block_levels

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for block, n, members in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                logs.append(append_log(members.values.field("digest").to_pylist(), block_shape(block, n, block_levels)[1]))
            found = [pa.array(["".join(log) for log in logs], pa.string()), pa.array([log[-1] for log in logs], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "log", "digest"])

    tiers: list[DataFrame] = []
    while True:
        block = F.floor(F.col("i") / size).alias("block")
        member = F.struct("i", "digest", *(carried if not tiers else ()))
        grouped = nodes.groupBy("tree", block).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
        kind = grouped.schema["members"].dataType.simpleString()
        written = grouped.mapInArrow(write, f"tree string, block long, n long, members {kind}, log string, digest string")
        tiers.append(stage(written, "log"))
        blocks = F.ceil(F.col("n") / size).cast("long")
        nodes = tiers[-1].where(F.col("n") > size).select("tree", F.col("block").alias("i"), blocks.alias("n"), "digest")
        if nodes.isEmpty():
            return tiers


def roots(tiers: list[DataFrame], block_levels: int) -> DataFrame:
    """(tree, digest): the root of each tree."""
    found = [t.where(F.col("n") <= ARITY**block_levels).select("tree", "digest") for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _below(tier: DataFrame, above: DataFrame, block_levels: int) -> DataFrame:
    """(tree, block, path) of the leaves of a tier, which are the blocks below it; ``above`` has the path of each of its blocks."""

    size = ARITY**block_levels

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, blocks, out = [], [], []
            for tree, block, n, log, rest in zip(*[c.to_pylist() for c in batch.columns]):
                siblings = Siblings(log, block, n, block_levels)
                trees += [tree] * siblings.n
                blocks += range(block * size, block * size + siblings.n)
                out += [siblings.of(j) + rest for j in range(siblings.n)]
            yield pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(blocks, pa.int64()), pa.array(out, pa.string())], ["tree", "block", "path"])

    both = tier.join(above, ["tree", "block"]).select("tree", "block", "n", "log", "path")
    return both.mapInArrow(read, "tree string, block long, path string")


def paths(tiers: list[DataFrame], block_levels: int) -> DataFrame:
    """(tree, block, path) of the blocks of the first tier: the siblings of their roots on the way to the root of their tree."""
    found = None
    for k in reversed(range(len(tiers))):
        here = tiers[k].where(F.col("n") <= ARITY**block_levels).select("tree", "block", F.lit("").alias("path"))
        found = here if found is None else stage(here.unionByName(_below(tiers[k + 1], found, block_levels)), "log-paths")
    return found


def manifest(docs: DataFrame, claim: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Blocks of the log over all rows of ``docs``: tree, block, n, members (i, digest, doc_id, claim), log, path, tree_index, trees, subroot, root.

    ``path`` holds the siblings from the block's root to the root of the dataset. ``claim`` is the leaf that someone holds of each row (by
    default the true one), which ``prove`` folds. Trees are the languages, null (first) as one of them; rows of a tree are ordered by doc_id, nulls first; rows that repeat a doc_id by their leaves,
    and equal rows are as many leaves. Null and empty texts, and texts of any length, are hashed like others; other columns are ignored; an empty table gives no blocks.
    """
    text = F.col("text")
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    # salt: equal rows may be any share of all, and are then dealt to several parts of the sort
    rows = docs.select(
        tree.alias("tree"), F.col("doc_id").alias("id"), leaf(text).alias("digest"), (leaf(text) if claim is None else claim).alias("claim"), F.monotonically_increasing_id().alias("salt")
    )
    rows = stage(rows, "leaves")
    tiers = build(numbered(rows, "id", "digest", "salt").drop("salt"), ("id", "claim"), block_levels)
    subroots = stage(roots(tiers, block_levels), "subroots")
    upper = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "name")
    upper_tiers = build(upper, ("name",), block_levels)
    members = upper_tiers[0].select("n", F.explode("members").alias("m"))
    trees = members.select(F.col("m.name").alias("tree"), F.col("m.i").alias("tree_index"), F.col("n").alias("trees"), F.col("m.digest").alias("subroot"))
    way = _below(upper_tiers[0], paths(upper_tiers, block_levels), block_levels).select(F.col("block").alias("tree_index"), F.col("path").alias("tree_path"))
    trees = stage(trees.join(way, "tree_index").withColumn("root", roots(upper_tiers, block_levels).select("digest").scalar()), "trees")
    blocks = tiers[0].drop("digest").join(paths(tiers, block_levels), ["tree", "block"]).join(trees, "tree")
    return blocks.withColumn("path", F.concat("path", "tree_path")).drop("tree_path")


def prove(blocks: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per leaf of the blocks that ``manifest`` gives: doc_id, leaf, subroot, root, index, proof, folded_root.

    ``proof`` is the text of the siblings, level by level up to the dataset's root, left to right; ``folded_root`` is what the row's claim and its proof lead to.
    """
    kind = {f.name: f.dataType.simpleString() for f in blocks.schema["members"].dataType.elementType.fields}["id"]
    schema = f"doc_id {kind}, leaf string, subroot string, root string, index long, proof string, folded_root string"
    names = ["doc_id", "leaf", "subroot", "root", "index", "proof", "folded_root"]

    size = ARITY**block_levels

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                column = lambda name: batch.column(name)[row].as_py()
                block, n, path, tree, trees = map(column, ("block", "n", "path", "tree_index", "trees"))
                siblings = Siblings(column("log"), block, n, block_levels)
                members = batch.column("members")[row].values
                for start in range(0, siblings.n, BATCH):
                    part = members.slice(start, BATCH)
                    proofs = [siblings.of(j) + path for j in range(start, start + len(part))]
                    index = range(block * size + start, block * size + start + len(part))
                    folded = [fold(c, p, (i, n), (tree, trees)) for c, p, i in zip(part.field("claim").to_pylist(), proofs, index)]
                    same = [pa.array([column(name)] * len(part), pa.string()) for name in ("subroot", "root")]
                    ends = [pa.array(index, pa.int64()), pa.array(proofs, pa.string()), pa.array(folded, pa.string())]
                    yield pa.RecordBatch.from_arrays([part.field("id"), part.field("digest"), *same, *ends], names)

    used = ("block", "n", "members", "log", "path", "tree_index", "trees", "subroot", "root")
    return blocks.select(*used).mapInArrow(read, schema)
