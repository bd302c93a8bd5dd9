"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Vectors with the same label link at a cosine of ``COSINE`` or more. Each goes to the cell of its nearest centre.
Two unit vectors with that cosine are at most ``REACH`` apart. If they lie in two cells, their distances to the plane between both centres
add up to no more than that, so one of them lies within half of it: it is a guest in the other's cell, and no link is
lost. Where both do, the pair counts in the lower cell only. A cell is cut into blocks of a bounded size; every pair of blocks is one task-sized product
that returns link counts and a spanning forest of the links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import components
from weekloom.session import stage

COSINE = 0.98
REACH = float(np.sqrt(2 - 2 * COSINE)) + 1e-9
HALF = REACH / 2 * (1 + 1e-6) + 1e-9
#: Centres that are closer than this don't tell their cells apart; all vectors of one are guests in the other.
CLOSE = 1e-4
#: Aimed size of a cell, most cells of a label and of all labels (they are sent to every task), rows of a block.
CELL, LABEL_CELLS, ALL_CELLS, BLOCK = 128, 2048, 32_768, 2048
#: Sampled vectors per centre for the fit, and its rounds.
SAMPLE, ROUNDS = 32, 8


def _units(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(rows that can link, their vectors scaled to length one in double precision)."""
    column = column.cast(pa.list_(pa.float64()))
    starts, values = column.offsets.to_numpy()[:-1], column.values.to_numpy(zero_copy_only=False)  # a null component is NaN
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), 0)
    kept, parts = [], []
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        x = np.ascontiguousarray(values[starts[rows][:, None] + np.arange(size)])
        largest = np.abs(x).max(1)
        good = np.isfinite(x).all(1) & (largest > 0)
        x = x[good] / largest[good, None]
        kept.append(rows[good])
        parts.append(x / np.sqrt((x * x).sum(1))[:, None])
    offsets = np.cumsum([0, *(n for p in parts for n in [p.shape[1]] * len(p))])
    flat = np.concatenate([p.ravel() for p in parts]) if parts else np.zeros(0)
    rows = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    return rows, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float64()))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, unit) of the vectors that can link, scaled to length one in double precision."""
    rows = vectors.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", "label", "embedding")

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, unit = _units(batch.column(2))
            ids = [batch.column(c).take(pa.array(kept)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, unit], ["vec_id", "label", "unit"])

    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    return rows.mapInArrow(scale, f"vec_id {kinds[0]}, label {kinds[1]}, unit array<double>")


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres; the first ones are spread over the sample in its order, an empty cell keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        cell = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return np.unique(centres, axis=0)


def fit_centres(units: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres per (label, dimension), fitted in one task per label on at most ``SAMPLE`` vectors for each centre.

    A label gets a centre for every ``CELL`` of its vectors, rounded up, fewer if the bounds on cells bind. The result is bounded by
    ``ALL_CELLS`` and the number of labels.
    """
    sizes = units.groupBy("label", F.size("unit").alias("dim")).count()
    total = sizes.agg(F.sum("count")).first()[0] or 0
    rate = min(1 / CELL, ALL_CELLS / max(total, 1))
    k = F.least(F.ceil(F.col("count") * rate), F.lit(LABEL_CELLS)).cast("int")
    plan = sizes.withColumn("k", k).withColumn("share", F.col("k") * SAMPLE / F.col("count")).select("label", "dim", "k", "share")
    draw = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) / 1_000_000
    sample = units.withColumn("dim", F.size("unit")).join(plan, ["label", "dim"]).where(draw < F.col("share"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        centres = spherical_kmeans(np.stack(group["unit"].to_numpy()), int(group["k"].iloc[0]))
        return pd.DataFrame({"label": group["label"].iloc[0], "dim": group["dim"].iloc[0], "centre": list(centres)})

    kind = units.schema["label"].dataType.simpleString()
    found = sample.groupBy("label", "dim").applyInPandas(fit, f"label {kind}, dim int, centre array<double>")
    centres: dict[tuple, list] = {}
    for row in found.collect():
        centres.setdefault((row["label"], row["dim"]), []).append(row["centre"])
    return {key: np.array(sorted(rows)) for key, rows in centres.items()}


def assign(units: DataFrame, centres: dict[tuple, np.ndarray]) -> DataFrame:
    """(label, dim, cell, guest, home, visits, vec_id, copies, unit): each vector in its cell, and as a guest where it may link.

    ``home`` is the vector's own cell, ``visits`` those where it is a guest. A label of which the sample has no vector is one cell.
    """
    known = units.sparkSession.sparkContext.broadcast(centres)
    columns = ["label", "dim", "cell", "guest", "home", "visits", "vec_id", "copies", "unit"]

    def place(batches):
        for batch in batches:
            parts = []
            for (label, dim), group in batch.groupby(["label", "dim"], sort=False):
                group = group.reset_index(drop=True)
                x = np.stack(group["unit"].to_numpy())
                c = known.value.get((label, dim), x[:0])
                if len(c) < 2:
                    parts.append(group.assign(cell=0, guest=False, home=0, visits=[[]] * len(group)))
                    continue
                for i in range(0, len(x), 1024):
                    part = group.iloc[i : i + 1024]
                    near = x[i : i + 1024] @ c.T
                    home = near.argmax(1)
                    gap = near[np.arange(len(near)), home][:, None] - near
                    between = np.sqrt(np.maximum(0, 2 - 2 * (c[home] @ c.T)))
                    guest = ((gap <= HALF * between) | (between < CLOSE)) & (np.arange(len(c)) != home[:, None])
                    row, cell = np.nonzero(guest)
                    visits = np.split(cell, np.cumsum(guest.sum(1))[:-1])
                    parts.append(part.assign(cell=home, guest=False, home=home, visits=visits))
                    parts.append(part.iloc[row].assign(cell=cell, guest=True, home=home[row], visits=[[]] * len(row)))
            yield pd.concat(parts)[columns]

    rows = units.withColumn("dim", F.size("unit"))
    kinds = {f.name: f.dataType.simpleString() for f in units.schema.fields}
    schema = f"label {kinds['label']}, dim int, cell int, guest boolean, home int, visits array<int>, vec_id {kinds['vec_id']}, copies long, unit array<double>"
    return rows.select("label", "dim", "vec_id", "copies", "unit").mapInPandas(place, schema)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a spanning forest of the links (a[i], b[i])."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for u, v in zip(a.tolist(), b.tolist()):
        p, q = find(u), find(v)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((u, v))
    return kept


def _counted_elsewhere(group: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    """Of vectors at home (rows) and guests (columns): pairs in which each visits the other's cell, and the guest's is the lower one."""
    guests = group["home"].to_numpy()[right]
    cell = int(group["cell"].iloc[0])
    lower = np.unique(guests[guests < cell])
    if not group["guest"].to_numpy()[right].any() or not len(lower):
        return None
    visits = group["visits"].to_numpy()[left]
    owner = np.repeat(np.arange(len(left)), [len(v) for v in visits])
    visited = np.concatenate([*visits, np.zeros(0, int)]).astype(int)
    back = np.zeros((len(left), len(lower) + 1), bool)  # the last column is for guests from higher cells
    known = np.isin(visited, lower)
    back[owner[known], np.searchsorted(lower, visited[known])] = True
    return back[:, np.where(guests < cell, np.searchsorted(lower, guests), len(lower))]


def compare(group: pd.DataFrame) -> pd.DataFrame:
    """Link counts (b null) and forest links (n null) between the two blocks of a group, or within its only one."""
    ids, copies, side = (group[c].to_numpy() for c in ("vec_id", "copies", "side"))
    x = np.stack(group["unit"].to_numpy())
    left, right = (np.flatnonzero(side == k) for k in (0, 1))
    same = not len(right) and bool(group["within"].iloc[0])
    right = left if same else right
    again = _counted_elsewhere(group, left, right)
    counts, links = np.zeros(len(ids), np.int64), []
    for i in range(0, len(left), 512):
        rows = left[i : i + 512]
        hit = x[rows] @ x[right].T >= COSINE
        if same:
            hit &= rows[:, None] != right[None, :]
        elif again is not None:
            hit &= ~again[i : i + 512]
        a, b = np.nonzero(hit)
        np.add.at(counts, rows[a], copies[right[b]])
        if not same:
            np.add.at(counts, right[b], copies[rows[a]])
        links += _forest(ids[rows[a]], ids[right[b]])
    linked = np.flatnonzero(counts)
    forest = _forest(*np.array(links, np.int64).reshape(-1, 2).T)
    return pd.DataFrame(
        {
            "a": np.concatenate([ids[linked], [u for u, _ in forest]]).astype(np.int64),
            "b": pd.array([None] * len(linked) + [v for _, v in forest], "Int64"),
            "n": pd.array([*counts[linked]] + [None] * len(forest), "Int64"),
        }
    )


def block_links(placed: DataFrame) -> DataFrame:
    """Link counts and forest links of all pairs of blocks: each home block with itself, with later ones and with guests."""
    by = ["label", "dim", "cell"]
    blocks = lambda guest: F.ceil(F.count_if(F.col("guest") == guest) / BLOCK).cast("int")
    sizes = placed.groupBy(*by).agg(blocks(False).alias("homes"), blocks(True).alias("guests"))
    rows = placed.join(sizes, by).where("homes > 0")
    own = F.pmod(F.xxhash64("vec_id"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
    rows = rows.withColumn("own", own)
    pair = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    me = F.col("own")
    at_home = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1), lambda j: pair(F.least(me, j), F.greatest(me, j), me > j)
    )
    with_guests = F.when(
        F.col("guests") > 0,
        F.transform(F.sequence(F.lit(0), F.col("guests") - 1), lambda g: pair(me, -g - 1, F.lit(0))),
    ).otherwise(F.expr("cast(array() as array<struct<i:int,j:int,side:int>>)"))
    as_guest = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda i: pair(i, -me - 1, F.lit(1)))
    all_pairs = F.explode(F.when(F.col("guest"), as_guest).otherwise(F.concat(at_home, with_guests)))
    spread = rows.withColumn("p", all_pairs).select(*by, "p.i", "p.j", "p.side", (F.col("p.i") == F.col("p.j")).alias("within"), "guest", "home", "visits", "vec_id", "copies", "unit")
    return spread.groupBy(*by, "i", "j").applyInPandas(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    ``vec_id`` is a whole number. Equal vectors of a label are one node with its number of copies. A vector that is null, zero or has null or
    non-finite components, a null label or a null id links with nothing: no links, its own component.
    Vectors of different length don't link. Repeated rows count as copies of each other. Other columns are ignored;
    an empty table gives no rows.
    """
    units = stage(valid_vectors(vectors), "units")
    nodes = stage(units.groupBy("label", "unit").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "nodes")
    placed = stage(assign(nodes, fit_centres(nodes)), "placed")
    found = stage(block_links(placed), "block-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    reached = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "member")
    groups = nodes.join(counts, nodes["vec_id"] == counts["node"], "left").join(reached, nodes["vec_id"] == reached["member"], "left")
    groups = stage(
        groups.select(
            "label", "unit", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", nodes["vec_id"]).alias("component_id")
        ),
        "vector-groups",
    )
    linked = units.join(groups, ["label", "unit"]).groupBy("vec_id").agg(F.max("n_links").alias("n"), F.min("component_id").alias("c"))
    out = vectors.select(F.col("vec_id").alias("id")).join(linked, F.col("id") == F.col("vec_id"), "left")
    component = F.coalesce("c", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
