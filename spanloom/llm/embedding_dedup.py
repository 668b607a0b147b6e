"""Near-duplicate embeddings by an epsilon grid order join (operator 9).

Vectors of one label and length are linked when their cosine, in double precision, reaches the threshold. For unit
vectors that is a distance of at most epsilon. Equal vectors are one class with a count. Classes are turned to
principal axes (fitted on at most SAMPLE of them; a rotation keeps every distance, so the fit decides speed only),
sorted by the cells of an epsilon grid on the LEADING axes, and cut into blocks of consecutive rows. Blocks whose
boxes on the leading axes are nearer than epsilon are joined: the two sequences are halved recursively, stretches
whose boxes are farther apart than epsilon are skipped, and short stretches are compared in full.

A block pair returns counts and a spanning set of links, not the pairs. Every linked pair is found: boxes on some
axes never overstate a distance.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite components, and rows without label,
link with nothing (n_links 0, their own component, kept); repeated rows link with each other as rows of their own;
vectors of different lengths are never compared; ties go to the least vec_id; an empty table gives no rows; other
columns are ignored; a null vec_id is kept false unless alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import column
from spanloom.operators.graph import connected_components
from spanloom.storage import materialize

THRESHOLD = 0.98
#: Leading principal axes that carry the grid and the boxes.
LEADING = 8
#: Classes that the axes are fitted on, at most.
SAMPLE = 4096
#: Rows of a block, and of a stretch that is compared in full.
BLOCK, LEAF = 2048, 64
_ROWS = "vec_id bigint, class string, label string, size int, vector binary"


def _classes_of(rows: DataFrame) -> DataFrame:
    """Each row with the name of its vector's class, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, labels = column(batch, "embedding"), column(batch, "label").to_pylist()
            off = np.asarray(vectors.offsets)
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # null as nan, -0 as 0
            valid = np.asarray(vectors.is_valid())
            names, sizes, blobs = [], [], []
            for i, label in enumerate(labels):
                own = flat[off[i] : off[i + 1]]
                if label is None or not valid[i] or not np.isfinite(own).all() or not own.any():
                    names.append(None), sizes.append(None), blobs.append(None)
                    continue
                blob = own.tobytes()
                names.append(hashlib.blake2b(blob, digest_size=16, key=hashlib.blake2b(label.encode(), digest_size=16).digest()).hexdigest()), sizes.append(len(own)), blobs.append(blob)
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), pa.array(names, pa.string()), column(batch, "label"), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())], [c.split()[0] for c in _ROWS.split(", ")])

    return rows.mapInArrow(run, _ROWS)


def _unit(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1, keepdims=True)  # first to a safe range
    scaled = vectors / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _axes(classes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Of each vector length its leading principal axes, fitted on the classes of least hash."""
    out = {}
    for size in [r[0] for r in classes.select("size").distinct().collect()]:
        rows = classes.where(F.col("size") == size).orderBy(F.xxhash64("class"), "class").limit(sample).select("vector").collect()
        unit = _unit(np.frombuffer(b"".join(bytes(r[0]) for r in rows), np.float64).reshape(len(rows), size))
        centred = unit - unit.mean(axis=0)
        _, _, axes = np.linalg.svd(centred.T @ centred)
        out[size] = axes[:LEADING].T.copy()
    return out


def _stretch_pairs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], eps: float):
    """Stretches of two sequences that may hold links, as slices; boxes are of the leading coordinates."""
    work = [(0, len(a[1]), 0, len(b[1]))]
    while work:
        i, j, k, m = work.pop()
        ca, cb = a[1][i:j], b[1][k:m]
        gap = np.maximum(np.maximum(ca.min(axis=0) - cb.max(axis=0), cb.min(axis=0) - ca.max(axis=0)), 0)
        if (gap * gap).sum() > eps * eps:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            yield slice(i, j), slice(k, m)
        elif j - i >= m - k:
            mid = (i + j) // 2
            work += [(i, mid, k, m), (mid, j, k, m)]
        else:
            mid = (k + m) // 2
            work += [(i, j, k, mid), (i, j, mid, m)]


def _links(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float, eps: float, same: bool) -> np.ndarray:
    """A boolean matrix of the links between two blocks."""
    out = np.zeros((len(a[1]), len(b[1])), bool)
    for i, k in _stretch_pairs(a, b, eps):
        out[i, k] = a[0][i] @ b[0][k].T >= threshold
    if same:
        np.fill_diagonal(out, False)
    return out


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for the edges (u, v) of n nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, u, root[v])
        np.minimum.at(root, v, root[u])
        if (before == root).all():
            return root


def link_embeddings(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    rows = materialize(_classes_of(rows), "vectors")
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-7
    classes = rows.where("class is not null").groupBy("class").agg(F.any_value("label").alias("label"), F.any_value("size").alias("size"), F.any_value("vector").alias("vector"), F.count("*").alias("times"), F.min("vec_id").alias("least"))
    classes = materialize(classes, "vector-classes")
    axes = _axes(classes, SAMPLE)
    cells = "class string, label string, size int, vector binary, times bigint, cells array<bigint>"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.floor(_unit(np.frombuffer(v, np.float64)[None]) @ axes[s] / eps)[0].astype(np.int64).tolist() for v, s in zip(column(batch, "vector").to_pylist(), column(batch, "size").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[column(batch, n) for n in ("class", "label", "size", "vector", "times")], pa.array(out, pa.list_(pa.int64()))], [c.split()[0] for c in cells.split(", ")])

    order = ["label", "size", "cells", "class"]
    n = classes.count()
    parts = max(1, min(n // (4 * block) + 1, 100_000))
    ordered = classes.select("class", "label", "size", "vector", "times").mapInArrow(placed, cells).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks_schema = "block string, label string, size int, low array<double>, high array<double>, classes array<string>, times array<bigint>, vectors binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block_of(held: list[tuple]) -> pa.RecordBatch:
            names, label, size, blobs, times = [h[0] for h in held], held[0][1], held[0][2], b"".join(h[3] for h in held), [h[4] for h in held]
            lead = _unit(np.frombuffer(blobs, np.float64).reshape(len(held), size)) @ axes[size]
            row = [names[0], label, size, lead.min(axis=0).tolist(), lead.max(axis=0).tolist(), names, times, blobs]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [c.split()[0] for c in blocks_schema.split(", ")])

        for batch in batches:
            for entry in zip(*[column(batch, c).to_pylist() for c in ("class", "label", "size", "vector", "times")], strict=True):
                if held and (len(held) >= block or held[0][1:3] != entry[1:3]):
                    yield block_of(held)
                    held = []
                held.append(entry)
        if held:
            yield block_of(held)

    blocks = materialize(ordered.mapInArrow(cut, blocks_schema), "vector-blocks")
    # blocks that share a cell of the first two axes, or lie in neighbouring ones, and whose boxes are near
    cell = lambda name, k: F.floor(F.try_element_at(name, F.lit(k)) / F.lit(eps))
    span = lambda k, more: F.sequence(F.coalesce(cell("low", k), F.lit(0)) - more, F.coalesce(cell("high", k), F.lit(0)) + more)
    boxes = blocks.select("block", "label", "size", "low", "high")
    grid = lambda more: boxes.withColumn("x", F.explode(span(1, more))).withColumn("y", F.explode(span(2, more)))
    left = grid(0).select("label", "size", "x", "y", F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    right = grid(1).select("label", "size", "x", "y", F.col("block").alias("b"), "low", "high")
    gaps = F.transform(F.arrays_zip("low", "high", "low_a", "high_a"), lambda z: F.greatest(z["low"] - z["high_a"], z["low_a"] - z["high"], F.lit(0.0)))
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= F.lit(eps * eps)
    pairs = left.join(right, ["label", "size", "x", "y"]).where((F.col("a") <= F.col("b")) & near).select("a", "b").distinct()
    one = blocks.select(F.col("block").alias("a"), "size", F.col("classes").alias("classes_a"), F.col("times").alias("times_a"), F.col("vectors").alias("vectors_a"))
    two = blocks.select(F.col("block").alias("b"), F.col("classes").alias("classes_b"), F.col("times").alias("times_b"), F.col("vectors").alias("vectors_b"))
    found_schema = "class string, links bigint, root string"

    def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = {n: column(batch, n)[i].as_py() for n in ("a", "b", "size", "classes_a", "times_a", "vectors_a", "classes_b", "times_b", "vectors_b")}
                a, b = (_unit(np.frombuffer(at[v], np.float64).reshape(-1, at["size"])) for v in ("vectors_a", "vectors_b"))
                lead = axes[at["size"]]
                same = at["a"] == at["b"]
                linked = _links((a, a @ lead), (b, b @ lead), threshold, eps, same)
                names = at["classes_a"] if same else at["classes_a"] + at["classes_b"]
                counts = linked @ np.array(at["times_b"], np.int64)
                u, v = np.nonzero(linked)
                roots = _roots(len(names), u, v if same else v + len(a))
                if not same:
                    counts = np.concatenate([counts, linked.T @ np.array(at["times_a"], np.int64)])
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in some], pa.string()), pa.array(counts[some]), pa.array([names[int(roots[k])] for k in some], pa.string())], ["class", "links", "root"])

    found = materialize(pairs.join(two, "b").join(one, "a").mapInArrow(join_blocks, found_schema), "vector-links")
    sums = found.groupBy("class").agg(F.sum("links").alias("links"))
    linked = connected_components(found.where("class <> root"), "class", "root").withColumnRenamed("node", "class")
    known = classes.select("class", "times", "least").join(sums, "class", "left").join(linked, "class", "left").select("class", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least", F.coalesce("component", "class").alias("component"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("class", "n_links", "component_id")
    out = rows.select("vec_id", "class").join(known, "class", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Every pair of one label compared; components by repeated reach.
OP9_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach(u, v) AS (
  SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), sums AS (SELECT u, count(*) AS n FROM links GROUP BY u), least AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN sums ON sums.u = vec_id LEFT JOIN least ON least.u = vec_id
"""
