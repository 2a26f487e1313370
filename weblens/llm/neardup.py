"""All pairs of embeddings with a cosine of at least a threshold, by PCA-ordered tiled comparison.

Vectors are normalised and rotated to their principal axes. On the first axes two linked vectors differ by at
most sqrt(2 - 2t), so only vectors in the same or touching cells of that width can link; cells are cut into
tiles of bounded size, ordered along the next axis, and tiles whose boxes lie too far apart never meet. A
task compares two tiles: leading dimensions first, then blocks of further ones, as long as the product so far
plus the product of the suffix norms can reach the threshold. Equal vectors are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weblens.llm.common import bounded_batches, running, staged
from weblens.llm.components import components

TILE = 2048
GRID_AXES = 3
STEPS = (8, 16, 32)
SLACK = 1e-9


def usable(vector: str) -> Column:
    """Whether a vector has a direction: not NULL, no NULL or non-finite component, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors in double precision) of a list column, for each dimension in it."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), dtype=np.float64)
    ends = np.cumsum(lengths)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, flat[(ends[rows] - dim)[:, None] + np.arange(dim)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # before squaring, so that no norm overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """The principal axes (columns) of the normalised vectors, by falling second moment. Shorter vectors are
    filled up with zeros; a partition sends one dim x dim matrix, and sums of them come to the driver."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, x in _matrix(batch.column(0)):
                x = unit(x)
                total[:x.shape[1], :x.shape[1]] += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)])], names=["m"])

    sums = (vectors.select("embedding").mapInArrow(moments, "m ARRAY<DOUBLE>")
            .select(F.posexplode("m").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect())
    total = np.zeros(dim * dim)
    for at, x in sums:
        total[at] = x
    return np.linalg.eigh(total.reshape(dim, dim))[1][:, ::-1]


def compare(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of rows of ``a`` and ``b`` (rotated unit vectors) that may reach ``threshold``; in a tile
    with itself only i < j. Pairs leave as soon as their bound is below it."""
    dim, block = a.shape[1], 512
    for i0 in range(0, len(a), block):
        x = a[i0:i0 + block]
        for j0 in range(i0 if same else 0, len(b), block):
            y = b[j0:j0 + block]
            done, alive, dots = 0, None, None
            for upto in [s for s in STEPS if s < dim] + [dim]:
                if alive is None:
                    dots = x[:, :upto] @ y[:, :upto].T
                    bound = dots + np.outer(np.sqrt((x[:, upto:] ** 2).sum(1)), np.sqrt((y[:, upto:] ** 2).sum(1)))
                    keep = bound >= threshold - SLACK
                    if same and i0 == j0:
                        keep &= np.triu(np.ones(keep.shape, dtype=bool), 1)
                    count = int(keep.sum())
                    if not count:
                        break
                    if count * 8 < keep.size:  # few: go on pair by pair
                        alive = np.nonzero(keep)
                        dots = dots[alive]
                    elif upto == dim:
                        yield tuple(k + o for k, o in zip(np.nonzero(keep), (i0, j0)))
                else:
                    i, j = alive
                    dots = dots + np.einsum("ij,ij->i", x[i, done:upto], y[j, done:upto])
                    rest = np.sqrt((x[:, upto:] ** 2).sum(1))[i] * np.sqrt((y[:, upto:] ** 2).sum(1))[j]
                    keep = dots + rest >= threshold - SLACK
                    alive, dots = (i[keep], j[keep]), dots[keep]
                    if not len(dots):
                        break
                done = upto
            if alive is not None and len(alive[0]) and done == dim:
                yield alive[0] + i0, alive[1] + j0


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def tile_links(ids_a, n_a, a, ids_b, n_b, b, rotation, threshold: float, same: bool) -> pd.DataFrame:
    """For each vector of two tiles with a link: how many vectors it links, and an edge of a spanning forest."""
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    copies = n_a if same else np.concatenate([n_a, n_b])
    raw_a, raw_b = unit(a), unit(b)
    turned_a = raw_a @ rotation[:a.shape[1]]
    turned_b = turned_a if same else raw_b @ rotation[:b.shape[1]]
    shift = 0 if same else len(ids_a)
    links, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    for i, j in compare(turned_a, turned_b, threshold, same):
        for k in range(0, len(i), 65536):
            p, q = i[k:k + 65536], j[k:k + 65536]
            real = np.einsum("ij,ij->i", raw_a[p], raw_b[q]) >= threshold  # in the order of the components
            p, q = p[real], q[real] + shift
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            # Only pairs that join two trees touch the forest; most pairs of a dense group do not.
            while len(p):
                tops = parent.copy()
                while (tops != tops[tops]).any():
                    tops = tops[tops]
                parent = tops
                apart = tops[p] != tops[q]
                p, q = p[apart], q[apart]
                if len(p):
                    low, high = np.minimum(tops[p], tops[q]), np.maximum(tops[p], tops[q])
                    parent[high] = low
    for x in range(len(parent)):
        parent[x] = _root(parent, x)
    linked = np.flatnonzero(links)
    return pd.DataFrame({"rep": ids[linked], "links": links[linked], "other": ids[parent[linked]]})


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, tile: int = TILE) -> DataFrame:
    """A row per row of ``embeddings`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are NULL, zero, or have NULL or non-finite components link with nothing, and so do vectors of
    different dimensions with each other. Every row is a vector of its own, also where a vec_id is repeated or NULL:
    it counts as a link of others, and component_id is the smallest vec_id of the vectors it reaches, NULL if none has one.
    No rows give no rows; other columns are left.
    """
    spark = embeddings.sparkSession
    bounded_batches(spark, rows=4096, size="16m")
    rows = staged(embeddings.select("vec_id", "embedding").withColumn("usable", usable("embedding")), "vectors")
    good = rows.filter("usable")
    # A class of equal vectors has a number of its own, as a vec_id may have several vectors.
    classes = staged(good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    dim = classes.agg(F.max(F.size("embedding"))).first()[0]
    if dim is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rotation = axes(classes, dim)
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK)
    axes_used = min(GRID_AXES, dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrix(batch.column(2)):
                turned = unit(x) @ rotation[:x.shape[1], :axes_used + 1]
                turned = np.pad(turned, ((0, 0), (0, axes_used + 1 - turned.shape[1])))
                cell = np.floor(turned[:, :axes_used] / width).astype(np.int32)
                cells = np.concatenate([np.full((len(x), 1), x.shape[1], np.int32), cell], axis=1)
                kept = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(list(cells), pa.list_(pa.int32())), pa.array(turned[:, -1])],
                    names=["rep", "copies", "embedding", "cell", "along"])

    placed = classes.select("rep", "copies", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        place, "rep BIGINT, copies BIGINT, embedding ARRAY<DOUBLE>, cell ARRAY<INT>, along DOUBLE")
    ranked = running(placed, ["cell"], ["along", "rep"], "rank", label="cells")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["embedding"].to_numpy())
        turned = unit(x) @ rotation[:x.shape[1]]
        return pd.DataFrame({
            "cell": [group["cell"].iloc[0]], "tile": [group["tile"].iloc[0]], "low": [turned.min(0)[:8]],
            "high": [turned.max(0)[:8]], "n": [len(x)], "ids": [group["rep"].to_numpy("<i8").tobytes()],
            "copies": [group["copies"].to_numpy("<i8").tobytes()], "vectors": [x.astype("<f8").tobytes()]})

    tiles = staged(ranked.withColumn("tile", F.expr(f"rank div {tile}")).groupBy("cell", "tile").applyInPandas(
        gather, "cell ARRAY<INT>, tile BIGINT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>, n BIGINT, ids BINARY, "
                "copies BINARY, vectors BINARY"), "tiles")

    # A tile meets later tiles of its own cell, and those of the touching cells that come after it.
    meta = tiles.select("cell", "tile", "low", "high")
    reach = [()]
    for _ in range(axes_used):
        reach = [(*r, s) for r in reach for s in (-1, 0, 1)]
    reach = [r for r in reach if r >= (0,) * axes_used]
    steps = F.array(*[F.array(*[F.lit(s) for s in (0, *r)]) for r in reach])
    left = meta.select(*[F.col(c).alias(f"a_{c}") for c in meta.columns], F.explode(steps).alias("step"))
    left = left.withColumn("next", F.zip_with("a_cell", "step", lambda x, s: x + s)).drop("step")
    right = meta.select(*[F.col(c).alias(f"b_{c}") for c in meta.columns])
    gaps = F.zip_with(F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y),
                      lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2))
    pairs = (left.join(right, F.col("next") == F.col("b_cell"))
             .filter((F.col("a_cell") != F.col("b_cell")) | (F.col("a_tile") <= F.col("b_tile")))
             .filter(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x) <= width * width)
             .select("a_cell", "a_tile", "b_cell", "b_tile"))
    pairs = staged(pairs, "tile-pairs")

    def side(s: str) -> DataFrame:
        return tiles.select(F.col("cell").alias(f"{s}_c"), F.col("tile").alias(f"{s}_t"),
                            *[F.col(c).alias(f"{s}_{c}") for c in ("ids", "copies", "vectors")])

    def meets(s: str) -> Column:
        return (F.col(f"{s}_cell") == F.col(f"{s}_c")) & (F.col(f"{s}_tile") == F.col(f"{s}_t"))

    names = ["a_ids", "a_copies", "a_vectors", "b_ids", "b_copies", "b_vectors"]
    joined = (pairs.join(side("a"), meets("a")).join(side("b"), meets("b"))
              .withColumn("same", (F.col("a_cell") == F.col("b_cell")) & (F.col("a_tile") == F.col("b_tile")))
              .select(*names, "same"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *sides, same in zip(*batch.columns):
                parts = []
                for ids, copies, vectors in (sides[:3], sides[3:]):
                    ids = np.frombuffer(ids.as_py(), "<i8")
                    parts += [ids, np.frombuffer(copies.as_py(), "<i8"),
                              np.frombuffer(vectors.as_py(), "<f8").reshape(len(ids), -1)]
                yield pa.RecordBatch.from_pandas(
                    tile_links(*parts, rotation, threshold, same.as_py()), preserve_index=False)

    found = staged(joined.mapInArrow(link, "rep BIGINT, links BIGINT, other BIGINT"), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links")).select(F.col("rep").alias("_of"), "links")
    reached = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    least = (reached.join(classes.select("rep", "least"), F.col("node") == F.col("rep"))
             .groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("_least")))
    reached = reached.join(least, F.col("component") == F.col("_component")).select("node", "_least")
    known = (classes.join(counts, F.col("rep") == F.col("_of"), "left")
             .join(reached, F.col("rep") == F.col("node"), "left")
             .select(F.col("embedding").alias("_vector"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
                     F.coalesce("_least", "least").alias("c")))
    component = F.coalesce("c", "vec_id")
    return (rows.join(known, F.col("usable") & (F.col("embedding") == F.col("_vector")), "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
                    component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")))
