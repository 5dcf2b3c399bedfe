"""Embedding near-dedup by counting collisions of one-dimensional projections.

Only vectors with equal labels and lengths are compared, by cosine in double
precision. ``cos >= c`` means that unit vectors are at most
``r = sqrt(2 - 2c)`` apart, and so are their projections on any unit vector.

1. *Classes.* Equal vectors of a label go on as one, with their number.
2. *Slabs.* A first projection is cut into slabs of width ``r``: linked vectors
   lie in one slab or in two that touch. A vector goes to its slab and, as a
   guest, to the one before. Slabs of any size are cut into blocks of at most
   ``BLOCK`` vectors, and pairs of blocks are the tasks' work.
3. *Counting.* In a block, ``PROJECTIONS`` further projections are sorted. For
   each query the windows around its values are found in the sorted lists and
   collisions are counted for each partner. A linked pair at distance ``r``
   collides in one window with probability ``2 Phi(WIDTH) - 1``; the count
   asked for is the largest that such a pair misses with probability under
   ``MISS``.
4. *Verifying.* Pairs that reach the count are compared exactly. Tasks return
   link counts and a spanning forest, not the links, so a group of n mutual
   neighbours gives about n rows.

Cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and rows without a label, link with nothing; repeated ids are
separate vectors; rows without an id take part, with a NULL ``component_id``
where no linked vector has one; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import components, staged

COSINE = 0.98
PROJECTIONS = 32
#: Half-width of the windows, in standard deviations of a linked pair's difference.
WIDTH = 2.5
MISS = 1e-9
BLOCK = 2048


def directions(size: int) -> np.ndarray:
    """Unit vectors as columns, the slab's first; the same in every task."""
    made = np.random.default_rng(size).standard_normal((size, PROJECTIONS + 1))
    return made / np.linalg.norm(made, axis=0)


def least_count(projections: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """The largest count that a pair at the threshold falls short of with probability under ``miss``."""
    p = math.erf(width / math.sqrt(2))
    total = 0.0
    for k in range(projections + 1):
        total += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if total > miss:
            return k
    return projections


def _slabs(radius: float):
    """Adds the slab of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            flat = batch.column(1).flatten()
            flat, at = np.asarray(flat), np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                v = flat[at[rows][:, None] + np.arange(size)].astype(np.float64)
                v /= np.linalg.norm(v, axis=1)[:, None]
                found[rows] = np.floor(v @ directions(size)[:, 0] / radius).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "slab"])

    return run


def _compare(left: list[tuple], right: list[tuple], cosine: float) -> list[tuple[int, int, int]]:
    """(node, n, NULL) link counts and (node, NULL, other) forest edges of two blocks (the same one twice: of its pairs)."""
    same = left is right
    size = len(left[0][1])
    a = np.array([r[1] for r in left], np.float64)
    b = a if same else np.array([r[1] for r in right], np.float64)
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    ways = directions(size)[:, 1:]
    pa_, pb = (a / norm_a[:, None]) @ ways, (b / norm_b[:, None]) @ ways
    # projections on a unit vector of a difference of length r have deviation r / sqrt(size)
    window = WIDTH * math.sqrt(max(0.0, 2 - 2 * cosine) / size) + 1e-12
    order = np.argsort(pb, axis=0)
    ranked = np.take_along_axis(pb, order, axis=0)
    low = np.stack([np.searchsorted(ranked[:, k], pa_[:, k] - window, "left") for k in range(PROJECTIONS)], 1).tolist()
    high = np.stack([np.searchsorted(ranked[:, k], pa_[:, k] + window, "right") for k in range(PROJECTIONS)], 1).tolist()
    lists = [np.ascontiguousarray(order[:, k]) for k in range(PROJECTIONS)]
    need = least_count()
    weight_a, weight_b = [r[2] for r in left], [r[2] for r in right]
    links_a, links_b = [0] * len(left), [0] * len(right)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in range(len(left)):
        hits = np.bincount(np.concatenate([x[lo:hi] for x, lo, hi in zip(lists, low[i], high[i], strict=True)]), minlength=len(right))
        near = np.flatnonzero(hits >= need)
        if same:
            near = near[near > i]
        if not len(near):
            continue
        near = near[(b[near] @ a[i]) / (norm_b[near] * norm_a[i]) >= cosine]
        for j in near.tolist():
            links_a[i] += weight_b[j]
            links_b[j] += weight_a[i]
            x, y = find(left[i][0]), find(right[j][0])
            if x != y:
                root[x] = y
                out.append((left[i][0], None, right[j][0]))
    counts = [(r[0], n, None) for r, n in zip(left, links_a, strict=True) if n] + [(r[0], n, None) for r, n in zip(right, links_b, strict=True) if n]
    return counts + out


def _blocks(cosine: float):
    """Rows sorted by work: (work, side, node, vector, number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: str | None = None
        sides: tuple[list, list] = ([], [])

        def done() -> pa.RecordBatch:
            rows = _compare(sides[0], sides[1] or sides[0], cosine) if sides[0] else []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["node", "n", "other"])

        for batch in batches:
            vectors = batch.column(3)
            for i, (work, side, node, number) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True)):
                if work != held:
                    if held is not None and (held.endswith("=") or sides[1]):
                        yield done()
                    held, sides = work, ([], [])
                sides[side].append((node, np.asarray(vectors[i].values), number))
        if held is not None and (held.endswith("=") or sides[1]):
            yield done()

    return run


def usable(column: str) -> Column:
    """Neither NULL nor empty nor zero, all components finite."""
    value = F.col(column).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(value) > 0) & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``. Runs jobs while it is built."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    rows = rows.withColumn("good", usable("v") & F.col("label").isNotNull())
    # equal vectors of a label have the same two hashes, one of which names them
    rows = staged(rows.withColumn("node", F.when(F.col("good"), F.xxhash64("label", "v"))).withColumn("check", F.when(F.col("good"), F.xxhash64(F.lit(7), "label", "v"))))
    good = rows.filter("good")
    classes = good.groupBy("node", "check").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("number"), F.min("vec_id").alias("least"))
    classes = classes.groupBy("node").agg(F.max_by(F.struct("label", "v"), "check").alias("x"), F.count(F.lit(1)).alias("kinds"), F.sum("number").alias("number"), F.min("least").alias("least"))
    classes = classes.withColumn("whole", F.assert_true(F.col("kinds") == 1, "two vectors share a 64-bit hash")).filter(F.col("whole").isNull())

    radius = math.sqrt(2 - 2 * cosine) * (1 + 1e-9)
    kind = classes.schema["x"].dataType["label"].dataType.simpleString()
    element = classes.schema["x"].dataType["v"].dataType.simpleString()
    placed = staged(classes.select("node", F.col("x.v").alias("v"), F.col("x.label").alias("label"), "number", "least").mapInArrow(_slabs(radius), f"node long, v {element}, label {kind}, number long, least long, slab long"))
    keys = ["label", "size", "slab"]
    sided = placed.withColumn("size", F.size("v")).select("node", "v", "number", "label", "size", F.explode(F.array(F.struct(F.col("slab").alias("slab"), F.lit(0).alias("side")), F.struct((F.col("slab") - 1).alias("slab"), F.lit(1).alias("side")))).alias("at"))
    sided = sided.select("node", "v", "number", "label", "size", "at.*")
    count = sided.groupBy(*keys).agg(F.ceil(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)) / BLOCK).cast("int").alias("own"), F.ceil(F.sum(F.col("side")) / BLOCK).cast("int").alias("guests"))
    sided = sided.join(count.filter("own > 0"), keys)
    block = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("guests"))).cast("int")
    sided = sided.withColumn("block", block)
    none = F.array().cast("array<struct<work: string, side: int>>")

    def pair(mark: str, first: Column, second: Column, side: Column) -> Column:
        return F.struct(F.concat_ws("/", "label", "size", "slab", first, second, F.lit(mark)).alias("work"), side.cast("int").alias("side"))

    own = F.sequence(F.lit(0), F.greatest(F.col("own") - 1, F.lit(0)))
    guests = F.when(F.col("guests") > 0, F.sequence(F.lit(0), F.greatest(F.col("guests") - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    # "=": a block with itself, "<": two blocks of the slab, ">": a block with a guest block
    own_work = F.concat(
        F.transform(own, lambda o: F.when(o == F.col("block"), pair("=", o, o, F.lit(0))).otherwise(pair("<", F.least(o, "block"), F.greatest(o, "block"), (F.col("block") > o)))),
        F.transform(guests, lambda g: pair(">", F.col("block"), g, F.lit(0))),
    )
    guest_work = F.transform(own, lambda o: pair(">", o, F.col("block"), F.lit(1)))
    work = sided.select("node", "v", "number", F.explode(F.when(F.col("side") == 0, own_work).when(F.col("side") == 1, guest_work).otherwise(none)).alias("w"))
    work = work.select("w.work", "w.side", "node", "v", "number").repartition("work").sortWithinPartitions("work")
    found = staged(work.mapInArrow(_blocks(cosine), "node long, n long, other long"))

    linked = found.filter(F.col("n").isNotNull()).groupBy("node").agg(F.sum("n").alias("n"))
    edges = found.filter(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b"))
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    grouped = components(ids, edges).withColumnRenamed("id", "node")
    nodes = placed.select("node", "number", "least").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(smallest, "component").join(linked, "node", "left").select("node", (F.coalesce("n", F.lit(0)) + F.col("number") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "node").join(nodes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""
