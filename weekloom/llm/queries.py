"""One query per operator over whole tables, and the SQL they equal where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import best_fit, decontaminate, licences, merkle_log, packing, perspectives, privacy, quality, ranked_search, secret_scan, simhash, toxicity, vector_dedup
from weekloom.llm.common import ascii_lower, of_kind, span_text
from weekloom.session import share_code

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op1_perspective_rotation",
    """
    WITH u AS (SELECT conv_id, turn, floor(turn / 64.0) AS part,
        replace(replace(coalesce(role, 'unknown'), '<|im_', '<| im_'), chr(10), ' ') AS s,
        replace(coalesce(text, ''), '<|im_', '<| im_') AS x
      FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT *, {'p': coalesce(part, -1e18),
        'r': (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, s, x) - 1) // 64} AS b FROM u),
    p AS (SELECT DISTINCT conv_id, s AS perspective FROM t WHERE s <> 'system'),
    h AS (SELECT conv_id, perspective, b, turn, s, x, s = perspective AS own,
        '<|im_start|>' || CASE WHEN s = perspective THEN 'assistant' WHEN s = 'system' THEN s ELSE 'user name=' || s END || chr(10) AS head
      FROM t JOIN p USING (conv_id)),
    g AS (SELECT *, head || x || '<|im_end|>' || chr(10) AS seg FROM h),
    o AS (SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, perspective ORDER BY b NULLS FIRST, turn NULLS FIRST, s, x ROWS UNBOUNDED PRECEDING) AS e FROM g),
    a AS (SELECT conv_id, perspective, b, min(e - length(seg)) AS start, count(*) AS n_turns, string_agg(seg, '' ORDER BY e) AS text,
        coalesce(string_agg((e - length(seg) + length(head)) || ':' || (e - 1), ',' ORDER BY e) FILTER (own), '') AS masks
      FROM o GROUP BY conv_id, perspective, b)
    SELECT conv_id, perspective, row_number() OVER (PARTITION BY conv_id, perspective ORDER BY b NULLS FIRST) - 1 AS part,
      CAST(start AS BIGINT) AS start, text, n_turns, masks FROM a""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = perspectives.rotate(table(spark, folder, "conversations"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return found.withColumn("masks", masks)


@query(
    "op2_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, folder, "embeddings"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op3_benchmark_decontamination",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
    b2 AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
    g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b2)),
    p AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g))),
    h AS (SELECT r, i, p.n, item FROM p JOIN g ON p.gram = g.gram AND p.n = g.n),
    c AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
    t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op5_secret_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"), ["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[of_kind(F.col("secrets"), k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )


@query("op6_information_theoretic_pii")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.find_personal_data(table(spark, folder, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*privacy.FORMATS))
    return found.select(
        "doc_id",
        *[of_kind(F.col("found"), k).alias(f"n_{k}") for k in privacy.FORMATS],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )


def _licence_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"CASE WHEN regexp_matches(n, {quoted(p)}) THEN {quoted(i)} END" for i, p in licences.SENTENCES)
    steps = "".join(
        f", q{k + 1} AS (SELECT *, replace(s{k}, {quoted(licences.rule_text(ids))}, '|') AS s{k + 1} FROM q{k})"
        for k, (_, ids) in enumerate(licences.RULES)
    )
    last = len(licences.RULES)
    hits = ", ".join(f"CASE WHEN s{k} <> s{k + 1} THEN {quoted(name)} END" for k, (name, _) in enumerate(licences.RULES))
    names = ", ".join(quoted(n) for n in dict.fromkeys(name for name, _ in licences.RULES))
    return rf"""
    WITH d AS (SELECT doc_id, list_transform(
        list_filter(string_split_regex(coalesce(text, ''), {quoted(licences.BREAK)}), lambda s: regexp_matches(s, {quoted(licences.HINT)})),
        lambda s: trim(regexp_replace(regexp_replace(lower(s), {quoted(licences.LATER)}, '\1 or later ', 'g'), {quoted(licences.GAP)}, ' ', 'g'))) AS ns FROM documents),
    i AS (SELECT doc_id, list_transform(ns, lambda n: list_filter([{known}], lambda v: v IS NOT NULL)) AS ids FROM d),
    q0 AS (SELECT doc_id, ids, coalesce(array_to_string(list_transform(flatten(ids), lambda v: '[' || v || ']'), ''), '') AS s0 FROM i){steps}
    SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, CAST(len(list_filter(ids, lambda v: len(v) = 0)) AS BIGINT) AS n_unknown,
      coalesce(array_to_string(flatten(ids), ','), '') AS sentence_ids,
      coalesce(array_to_string(list_filter([{names}], lambda v: list_contains([{hits}], v)), ','), '') AS licences,
      replace(s{last}, '|', '') AS unmatched FROM q{last}"""


@query("op7_licence_sentence_rules", _licence_sql())
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return licences.find_licences(table(spark, folder, "documents"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_toxicity_ftrl")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _merkle_sql(depth: int = 10, upper_depth: int = 4) -> str:
    """Levels one by one: trees of up to 8**depth rows, and up to 8**upper_depth of them."""
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    # DuckDB has no crc32
    shifts = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    letters = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    crc = f"xor(list_reduce([4294967295] || {letters}, lambda c, b: {shifts}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(nodes: str, claims: str, name: str, levels: int) -> str:
        """``nodes`` (t, i, h) up to their roots; ``claims`` (r, t, i, p, d) along, p the siblings so far, d the folded hash."""
        out = f", {name}0 AS ({nodes}), {name}p0 AS ({claims})"
        for k in range(levels):
            out += f""",
    {name}r{k} AS (SELECT t, i // 8 AS b, list(h ORDER BY i) AS hs, max(c) > 1 AS more FROM (SELECT *, count(*) OVER (PARTITION BY t) AS c FROM {name}{k}) GROUP BY t, i // 8),
    {name}{k + 1} AS (SELECT t, b AS i, CASE WHEN more THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{k}),
    {name}p{k + 1} AS (SELECT r, t, b AS i, CASE WHEN more THEN p || array_to_string(hs[1:i % 8] || hs[i % 8 + 2:], '') ELSE p END AS p,
        CASE WHEN more THEN sha256(array_to_string(hs[1:i % 8] || [d] || hs[i % 8 + 2:], '')) ELSE d END AS d
      FROM {name}p{k} JOIN {name}r{k} USING (t) WHERE b = i // 8)"""
        return out

    lower = tree("SELECT t, i, h FROM l", "SELECT r, t, i, '' AS p, g AS d FROM l", "a", depth)
    upper = tree(
        f"SELECT '' AS t, row_number() OVER (ORDER BY t) - 1 AS i, h FROM a{depth}",
        f"SELECT r, '' AS t, k.i, p, d FROM ap{depth} JOIN (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i FROM a{depth}) k USING (t)",
        "b",
        upper_depth,
    )
    return f"""
    WITH g AS (SELECT doc_id, coalesce('=' || lang, '') AS t, {leaf('text')} AS h, CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS g FROM documents),
    l AS (SELECT row_number() OVER () AS r, *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM g){lower}{upper}
    SELECT doc_id, l.h AS leaf, s.h AS subroot, root.h AS root, sha256(e.p) AS proof_sha256, e.d AS folded_root, e.d = root.h AS verified
    FROM l JOIN a{depth} s ON s.t = l.t JOIN bp{upper_depth} e ON e.r = l.r, b{upper_depth} root"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    lowered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = merkle_log.leaf(F.when(lowered, ascii_lower(F.col("text"))).otherwise(F.col("text")))
    found = merkle_log.prove(merkle_log.manifest(table(spark, folder, "documents"), claim))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


_TERMS = r"translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op12_ranked_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    t AS (SELECT r, t, count(*) AS tf FROM (SELECT r, {_TERMS} AS t FROM d) GROUP BY r, t),
    n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY r),
    s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
    w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY t),
    q AS (SELECT k, item_id, {_TERMS} AS t FROM (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT item_id, text FROM benchmark))),
    x AS (SELECT k, item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM (SELECT DISTINCT * FROM q) JOIN t USING (t) JOIN w USING (t) JOIN n USING (r), s GROUP BY k, item_id, r),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM x JOIN d USING (r) WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_best_fit_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    documents, checksum = table(spark, folder, "documents"), {"ids_crc32": F.crc32("ids")}
    return best_fit.pack(documents, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), keep=checksum)
