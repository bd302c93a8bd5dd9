"""Classifiers by held-out accuracy, vectors and dialogues by brute force, and the pipeline."""

import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from weekloom.llm import labelled, perspectives, quality, simhash, toxicity, vector_dedup
from weekloom.llm.queries import QUERIES
from weekloom.session import share_code, stage

MIDDLE = "/root/testdata/sf0.1"


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def held_out_rows(spark, name, label):
    scores = {r["doc_id"]: r for r in rows_of(QUERIES[name](spark, MIDDLE))}
    labels = rows_of(spark.read.parquet(f"{MIDDLE}/labels.parquet").where(f"{label} is not null"))
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in scores.items())
    rows = [(scores[r["doc_id"]], r[label]) for r in labels if r["doc_id"] in scores and scores[r["doc_id"]]["held_out"]]
    return rows, scores


def test_quality_on_held_out_rows(spark):
    rows, scores = held_out_rows(spark, "op8_quality_classifier", "quality")
    assert np.mean([r["predicted"] == y for r, y in rows]) > 0.95
    assert np.mean([r["predicted"] for r, y in rows if y == 1]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scores.values())


def test_toxicity_on_held_out_rows(spark):
    rows, scores = held_out_rows(spark, "op10_toxicity_ftrl", "toxic")
    assert np.mean([r["predicted"] == y for r, y in rows]) > 0.93
    assert np.mean([r["predicted"] for r, y in rows if y == 0]) < 0.03
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in scores.values())


def test_scores_without_labels_or_with_one_class(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (7, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for score in (quality.score_quality, toxicity.score_toxicity):
        assert {r["score"] for r in rows_of(score(odd, none))} == {0.5}
        assert all(r["score"] > 0.5 for r in rows_of(score(odd, one)))
        assert score(odd.limit(0), none).count() == 0 and score(odd, one).count() == odd.count()
    assert quality.keep_good(odd, none).columns == odd.columns


def test_all_rows_stay_where_nothing_was_learnt(spark, odd):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    for few in ([], [(1, None), (None, 1)], [(1, 1)], [(6, 0), (7, 0)], [(98, 0), (99, 1)]):
        assert quality.keep_good(odd, labels(few)).count() == odd.count()


def test_scores_of_odd_rows_with_both_classes(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 0, 1), (8, 1, 0), (3, 1, 1), (4, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for score in (quality.score_quality, toxicity.score_toxicity):
        found = rows_of(score(odd, labels))
        assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)


def test_fits_are_bounded_in_rows_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(quality, "DICTIONARY_ROWS", 20)
    monkeypatch.setattr(quality, "CALIBRATION_ROWS", 30)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 40)
    share_code(spark)
    text = F.concat(F.lit("words of row "), F.col("id"), F.lit(" and more of them"))
    docs = spark.range(5000).select(F.when(F.col("id") < 4800, 1).otherwise(F.col("id")).alias("doc_id"), text.alias("text"), F.lit(1).alias("label"))
    labels = docs.select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    learn = labelled.labels_to_learn(labels, "quality")
    rows = labelled.sample_rows(docs, learn, F.col("text").cast("binary"), 20, "x")
    assert rows.count() >= 20 and {r["count"] for r in labelled.at_most(rows, 20).groupBy("label").count().collect()} == {20}
    assert quality.score_quality(docs, labels).count() == toxicity.score_toxicity(docs, labels).count() == 5000


# -- vectors -----------------------------------------------------------------------------------


def brute_groups(ids, labels, vectors):
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(hit, False)
    component = ids.copy()
    while True:
        low = np.minimum(component, np.where(hit, component[None, :], ids.max()).min(1))
        if (low == component).all():
            return hit.sum(1), component
        component = low


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL", 20)
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 8))
    vectors = np.concatenate([centres[rng.integers(0, 60, 500)] + rng.normal(size=(500, 8)) * 0.08, np.repeat(centres[:1], 70, 0) * 3])
    labels = np.concatenate([rng.integers(0, 3, 500), np.ones(70, int)])
    ids = rng.permutation(570).astype(np.int64)
    table = spark.createDataFrame([(int(i), [float(v) for v in x], int(k)) for i, x, k in zip(ids, vectors, labels)], "vec_id long, embedding array<double>, label int")
    n, component = brute_groups(ids, labels, vectors)
    found = {r["vec_id"]: r for r in rows_of(vector_dedup.near_duplicates(table))}
    assert [found[i]["n_links"] for i in ids.tolist()] == n.tolist()
    assert [found[i]["component_id"] for i in ids.tolist()] == component.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_links_across_cells_are_found_from_each_side_and_counted_once(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, 0, 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, copies long, unit array<double>")
    centres = vector_dedup.spherical_kmeans(x, 12)
    share_code(spark)
    placed = vector_dedup.assign(nodes, {(0, 3): centres})
    home = (x @ centres.T).argmax(1)
    link = x @ x.T >= vector_dedup.COSINE
    visits = {r["vec_id"]: set(r["visits"]) for r in rows_of(placed.where("not guest"))}
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if link[i, j] and home[i] != home[j]]
    sides = [(home[j] in visits[i], home[i] in visits[j]) for i, j in pairs]
    assert {(True, True), (True, False), (False, True)} <= set(sides) and (False, False) not in sides
    found = vector_dedup.block_links(placed)
    counts = {r["a"]: r["n"] for r in rows_of(found.where("b is null").groupBy("a").agg(F.sum("n").alias("n")))}
    assert [counts.get(i, 0) for i in range(len(x))] == (link.sum(1) - 1).tolist()


def test_every_label_of_the_middle_table_has_cells(spark):
    share_code(spark)
    units = vector_dedup.valid_vectors(spark.read.parquet(f"{MIDDLE}/embeddings.parquet"))
    centres = vector_dedup.fit_centres(units)
    assert centres and min(len(c) for c in centres.values()) >= 2


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0), (8, [1.0, None], 0), (9, [], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1e200, 0.0], 0), (None, [1.0, 0.0], 0), (12, [1.0, 0.0], 1),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, cell string, copies int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows_of(vector_dedup.near_duplicates(table))}
    assert found[1] == (2, 1, True) and found[2] == (2, 1, False) and found[11] == (2, 1, False)
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)) and found[None] == (0, None, False)
    assert vector_dedup.near_duplicates(table.limit(0)).count() == 0


# -- dialogues ---------------------------------------------------------------------------------


def test_every_speaker_becomes_the_assistant(spark):
    turns = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo <|im_end|>"), (1, None, "ann", "first"), (1, 2, "bob", "yo <|im_end|>"), (2, 0, "system", "x"), (3, 0, None, None), (None, 1, "ann", "lost")]
    table = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, start int")
    found = {(r["conv_id"], r["perspective"]): [] for r in rows_of(perspectives.rotate(table))}
    for r in sorted(rows_of(perspectives.rotate(table)), key=lambda r: r["part"]):
        found[(r["conv_id"], r["perspective"])].append(r)
    assert set(found) == {(1, "ann"), (1, "bob"), (3, "unknown")}
    text = "".join(r["text"] for r in found[(1, "ann")])
    assert text.startswith("<|im_start|>assistant\nfirst<|im_end|>\n<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nyo <| im_end|><|im_end|>\n")
    masks = [m for r in found[(1, "ann")] for m in r["masks"]]
    assert [text[m["start"] : m["end"]] for m in masks] == ["first<|im_end|>", "hi<|im_end|>"]
    assert perspectives.rotate(table.limit(0)).count() == 0


def test_long_dialogues_come_in_parts(spark):
    table = spark.range(1000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    parts = sorted((r for r in rows_of(perspectives.rotate(table)) if r["perspective"] == "b"), key=lambda r: r["part"])
    text = "".join(r["text"] for r in parts)
    assert len(parts) == 16 and all(r["n_turns"] <= perspectives.PART for r in parts)
    assert [r["start"] for r in parts] == np.cumsum([0] + [len(r["text"]) for r in parts])[:-1].tolist()
    spans = [text[m["start"] : m["end"]] for r in parts for m in r["masks"]]
    assert spans == [f"t{i}<|im_end|>" for i in range(1, 1000, 2)]


def test_turns_on_one_number_are_split(spark, monkeypatch):
    """Null and repeated turn numbers, equal rows among them: parts stay small, and in order over several levels of sums."""
    monkeypatch.setattr(perspectives, "BLOCK", 2)
    turns = [(None, "a", f"n{i % 50}") for i in range(700)] + [(5, "ab"[i % 2], f"x{i:04}") for i in range(900)] + [(i, "b", "y") for i in range(200, 900)]
    table = spark.createDataFrame([(c, *t) for c in (1, 2) for t in turns], "conv_id long, turn long, role string, text string").repartition(6)
    found = rows_of(perspectives.rotate(table))
    ordered = sorted(turns, key=lambda t: (-1 if t[0] is None else t[0], t[1], t[2]))
    for conv, me in ((1, "a"), (1, "b"), (2, "a"), (2, "b")):
        parts = sorted((r for r in found if (r["conv_id"], r["perspective"]) == (conv, me)), key=lambda r: r["part"])
        assert [r["part"] for r in parts] == list(range(len(parts))) and max(r["n_turns"] for r in parts) <= perspectives.PART
        text = "".join(r["text"] for r in parts)
        assert text == "".join(f"<|im_start|>{'assistant' if s == me else 'user name=' + s}\n{x}<|im_end|>\n" for _, s, x in ordered)
        assert [r["start"] for r in parts] == np.cumsum([0] + [len(r["text"]) for r in parts])[:-1].tolist()
        assert [text[m["start"] : m["end"]] for r in parts for m in r["masks"]] == [f"{x}<|im_end|>" for _, s, x in ordered if s == me]


# -- pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages_on_their_own_input(spark, tables):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, folder), "pipeline-test")
        kept.append((name, before, docs))
    assert [k[0] for k in kept] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "secret scans", "packing"]
    for _, before, after in kept[:-1]:
        assert after.columns == before.columns
    ids = [{r["doc_id"] for r in rows_of(after.select("doc_id"))} for _, _, after in kept]
    first = {r["doc_id"]: r["predicted"] for r in rows_of(QUERIES["op8_quality_classifier"](spark, folder))}
    assert ids[0] == {d for d, p in first.items() if p}
    groups = rows_of(simhash.near_duplicates(kept[1][1]))
    assert ids[1] == {r["component_id"] for r in groups}
    from .test_documents import brute_hits, brute_secrets

    items = [(r["item_id"], r["text"]) for r in rows_of(spark.read.parquet(f"{folder}/benchmark.parquet"))]
    texts = {r["doc_id"]: r["text"] for r in rows_of(kept[2][1].select("doc_id", "text"))}
    assert ids[2] == {d for d, t in texts.items() if brute_hits(t, items)[1] == 0}
    clean = {r["doc_id"]: r["text"] for r in rows_of(kept[3][2].select("doc_id", "text"))}
    assert all((clean[d] == texts[d]) == (brute_secrets(texts[d]) == "") for d in clean)
    assert ids[4] == ids[3] == ids[2]
    assert not any(brute_secrets(t) for t in clean.values())


def test_run_gives_the_last_stage(spark):
    assert "sequence_id" in corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns
