"""The manifest against a plain tree, and places in the log against the order of appending."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from weekloom.llm import merkle_log
from weekloom.llm.merkle_log import ARITY


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    fields = [None if r[c] is None else str(r[c]) for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return h("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def plain_tree(leaves):
    """(root, siblings of each leaf level by level)."""
    nodes, at, proofs = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for j, place in enumerate(at):
            run = place // ARITY * ARITY
            proofs[j] += [x for k, x in enumerate(nodes[run : run + ARITY], run) if k != place]
            at[j] = place // ARITY
        nodes = [h("".join(nodes[k : k + ARITY])) for k in range(0, len(nodes), ARITY)]
    return (nodes or [None])[0], proofs


def plain_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault("" if r["lang"] is None else "=" + r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r["doc_id"]))
    names = sorted(trees, key=str.encode)
    found = {t: (sorted(x[:3] for x in trees[t]), trees[t]) for t in names}
    subroots = {t: plain_tree([x[2] for x in found[t][0]]) for t in names}
    root, upper = plain_tree([subroots[t][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for (known, doc, leaf), proof in zip(found[t][0], subroots[t][1]):
            out.append((str(doc if known else None), leaf, subroots[t][0], root, "".join(proof + upper[k])))
    return sorted(out)


def test_places_follow_from_subtree_sizes():
    rng = random.Random(1)
    for n in [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, *rng.sample(range(1, 5000), 25)]:
        for top in {merkle_log.levels(n), merkle_log.levels(n) + 1, 4}:
            if ARITY**top < n:
                continue
            leaves = [h(f"{n}:{j}") for j in range(n)]
            log = merkle_log.append_log(leaves, top)
            nodes, seen = leaves, set()
            for k in range(top + 1):
                for j, node in enumerate(nodes):
                    at = merkle_log.position(k, j, n, top)
                    assert log[at] == node
                    seen.add(at)
                nodes = [h("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
            assert seen == set(range(len(log))) and len(log) == merkle_log.subtree(n, top)


def compare(docs, block_levels=merkle_log.BLOCK_LEVELS):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = [r.asDict() for r in merkle_log.prove(merkle_log.manifest(docs, block_levels=block_levels), block_levels).collect()]
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found) == plain_manifest(rows)
    assert all(r["folded_root"] == r["root"] for r in found)


def test_manifest_equals_a_plain_tree(spark, tables):
    compare(tables("documents"))
    compare(tables("documents"), 1)
    many = spark.range(700).select((F.col("id") * 7 % 700).alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("l"), F.col("id") % 90).alias("lang"), F.lit(1).alias("n_chars"), F.lit("x").alias("text"))
    compare(many.unionByName(many.where("doc_id < 9").limit(3)), 1)


def test_manifest_of_odd_rows(spark, odd):
    docs = odd.withColumns({"source": F.lit(None).cast("string"), "n_chars": F.length("text"), "tree": F.lit(1), "digest": F.lit("d"), "i": F.lit(0), "n": F.lit(0), "id": F.lit(4), "salt": F.lit(1)})
    docs = docs.unionByName(docs.where("doc_id = 1"))
    compare(docs)
    compare(docs.where("doc_id = 7"))
    empty = merkle_log.manifest(docs.limit(0))
    assert merkle_log.prove(empty).count() == 0


def test_a_changed_text_leads_to_another_root(tables):
    changed = F.col("doc_id") % 5 == 0
    claim = merkle_log.leaf(F.when(changed, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    for r in merkle_log.prove(merkle_log.manifest(tables("documents"), claim)).collect():
        assert (r["folded_root"] == r["root"]) == (r["doc_id"] % 5 != 0)


def test_tampered_thirds(spark):
    from weekloom.llm.queries import QUERIES

    from .conftest import FOLDER

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op11_merkle_manifest"](spark, FOLDER).collect():
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[r["doc_id"]])
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 != 0 or lower == texts[r["doc_id"]])
