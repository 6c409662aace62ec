"""Near-duplicate vectors by an inverted multi-index with exact verification.

Vectors are scaled to length one and cut into halves.  Each half has a codebook of its own, fitted on a
bounded sample; the pairs of codes form the cells of a product grid.  Every vector lies in the cell of
its nearest codes.  As a query it visits cells in the order of their distance (the sum over the halves
of the squared distance from the border of the code's cell), by multi-sequence traversal: from its
own cell on, a heap holds the next code of either half.  It stops at the first cell beyond
the reach.  At a target recall of 1 the reach is the distance of a pair right at the threshold: a
vector within it cannot lie in a cell whose border is farther away, so nothing is missed.  For a lower target
it is fitted: sampled vectors get neighbours at exactly that cosine whose difference lies in all
places, in one half or in a few places, and the reach is the target quantile of how far such a step
goes towards the code that it nears most, for the worst of the shapes.

Of two cells the one of lower number visits the other, so a pair meets once.  A cell's vectors and its
visitors are compared by cosine in double precision, in blocks: a cell of any size is dealt out to
a task for each pair of blocks, as matrix products.  Only sums of links and a spanning star per
connected set leave a task, never pairs.  Equal vectors of a label are compared once.

Only vectors of equal label and equal length are compared.  A NULL label, a NULL or empty vector, one
of zeros only, or with a NULL, infinite or NaN component links with nothing.  Repeated rows, also with one
id, are vectors of their own and link with each other.  NULL ids count as the largest.  An empty
table gives an empty one.  Only id, vector and label are read; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import bounded_sample, sorted_groups, written
from spanlake.llm.components import components

THRESHOLD = 0.93
RECALL = 0.999
"""Share of the pairs at the threshold that have to meet."""

SAMPLE_ROWS = 65_536
SAMPLE_BYTES = 64 << 20
"""The codebooks are fitted on at most so many vectors and bytes."""

CELL_VECTORS = 256
"""Vectors of a label that a cell holds on average; decides the codes of a half."""

MOST_CODES = 512

BLOCK = 1024
"""Vectors that a task compares at once with themselves or another block."""

ROUNDS = 12
TRIALS = 4_096


class Grid(NamedTuple):
    """Codebooks of both halves of vectors of (padded) length ``dims``, and how far to visit."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def codes(self) -> int:
        return len(self.first)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; the largest component is scaled first, so no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def squared_distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    found = (points * points).sum(1)[:, None] - 2 * points @ codes.T + (codes * codes).sum(1)
    return np.maximum(found, 0)


def codebook(points: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Means of ``count`` clusters; a code that no point is nearest to stays where it was."""
    codes = points[rng.permutation(len(points))[:count]].copy()
    for _ in range(ROUNDS):
        nearest = squared_distances(points, codes).argmin(1)
        size = np.bincount(nearest, minlength=len(codes))
        total = np.zeros_like(codes)
        np.add.at(total, nearest, points)
        codes[size > 0] = total[size > 0] / size[size > 0, None]
    return codes


def neighbours(
    vectors: np.ndarray, cosine: float, shape: str, rng: np.random.Generator
) -> np.ndarray:
    """For each vector one at the cosine; ``shape`` says where they differ."""
    n, dims = vectors.shape
    change = rng.standard_normal((n, dims))
    if shape == "first":
        change[:, dims // 2 :] = 0
    elif shape == "second":
        change[:, : dims // 2] = 0
    elif shape == "few":
        change *= rng.random((n, dims)) < 4 / dims
    change -= (change * vectors).sum(1, keepdims=True) * vectors
    size = np.sqrt((change * change).sum(1, keepdims=True))
    change = np.divide(change, size, out=np.zeros_like(change), where=size > 1e-9)
    return cosine * vectors + np.sqrt(1 - cosine**2) * change


def crossings(grid: Grid, vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared step from each vector to its other one towards the code that it nears most.

    Wherever a vector lies in its cell, the other one is in no cell whose border is farther away.
    """
    half = grid.dims // 2
    total = np.zeros(len(vectors))
    for codes, part in ((grid.first, slice(0, half)), (grid.second, slice(half, None))):
        own = codes[squared_distances(vectors[:, part], codes).argmin(1)]
        step = others[:, part] - vectors[:, part]
        apart = np.sqrt(squared_distances(own, codes))
        ahead = step @ codes.T - (step * own).sum(1)[:, None]
        ahead = np.divide(ahead, apart, out=np.zeros_like(ahead), where=apart > 1e-9)
        total += np.maximum(ahead, 0).max(1) ** 2
    return total


def borders(far: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Squared distance of a half from the border of each code's cell, 0 for the nearest code.

    ``far`` are its squared distances from the codes, ``apart`` those of the nearest code from them.
    """
    ahead = (far - far.min()) ** 2
    return np.divide(ahead, 4 * apart, out=np.zeros_like(ahead), where=(ahead > 0) & (apart > 0))


def fitted(
    sample: np.ndarray, codes: int, threshold: float, recall: float, seed: int = 11
) -> Grid:
    """Grid of unit vectors, with the reach that meets the recall at the threshold."""
    farthest = max(0.0, 2 - 2 * threshold) + 1e-9
    rng = np.random.default_rng(seed)
    half = sample.shape[1] // 2
    codes = max(1, min(codes, len(sample)))
    grid = Grid(
        sample.shape[1],
        codebook(sample[:, :half], codes, rng),
        codebook(sample[:, half:], codes, rng),
        farthest,
    )
    if recall >= 1:
        return grid
    tried = sample[rng.permutation(len(sample))[:TRIALS]]
    reach = max(
        float(np.quantile(crossings(grid, tried, neighbours(tried, threshold, shape, rng)), recall))
        for shape in ("all", "first", "second", "few")
    )
    return grid._replace(reach=min(reach, farthest))


def nearest_cells(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells in the order of the sum of both halves' distances, up to ``reach``."""
    order, other = first.argsort(kind="stable"), second.argsort(kind="stable")
    a, b = first[order].tolist(), second[other].tolist()
    heap, found = [(a[0] + b[0], 0, 0)], []
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        found.append((int(order[i]), int(other[j])))
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return found


def cells(grid: Grid, vectors: np.ndarray) -> list[list[int]]:
    """For each unit vector its own cell, then the cells of higher number that it visits."""
    half = grid.dims // 2
    first = squared_distances(vectors[:, :half], grid.first)
    second = squared_distances(vectors[:, half:], grid.second)
    apart = [squared_distances(codes, codes) for codes in (grid.first, grid.second)]
    made = []
    for a, b in zip(first, second):
        i, j = int(a.argmin()), int(b.argmin())
        own = i * grid.codes + j
        near = nearest_cells(borders(a, apart[0][i]), borders(b, apart[1][j]), grid.reach)
        made.append([own, *(c for c in (i * grid.codes + j for i, j in near) if c > own)])
    return made


def padded(raw: list[bytes], kind: np.dtype, dims: int) -> np.ndarray:
    """Unit vectors of serialised ones, with zeros behind them up to ``dims``."""
    made = np.zeros((len(raw), dims))
    for i, r in enumerate(raw):
        v = np.frombuffer(r, kind)
        made[i, : len(v)] = v
    return unit(made) if raw else made


def serialised(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``id``, ``label`` as text, ``vec`` (bytes) and ``key``; the last two NULL where nothing links."""
    kind = dict(vectors.dtypes)[vec_id]
    double = "double" in dict(vectors.dtypes)[embedding]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.float64 if double else np.float32
        for batch in batches:
            lists, labels = batch.column("v"), batch.column("label").to_pylist()
            keys, raws = [], []
            for i, name in enumerate(labels):
                key = raw = None
                if name is not None and lists[i].is_valid:
                    values = lists[i].values
                    if not values.null_count and len(values):
                        v = values.to_numpy(zero_copy_only=False).astype(dtype) + 0  # no -0
                        if np.isfinite(v).all() and v.any():
                            raw = v.tobytes()
                            key = xxhash.xxh3_128_digest(f"{len(name)}:{name}".encode() + raw)
                keys.append(key)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(raws, pa.binary()), pa.array(keys, pa.binary())],
                ["id", "label", "vec", "key"],
            )

    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{embedding}`").cast("array<double>" if double else "array<float>").alias("v"),
    )
    return rows.mapInArrow(convert, f"id {kind}, label string, vec binary, key binary")


def fit(distinct: DataFrame, kind: np.dtype, threshold: float, recall: float) -> Grid | None:
    """Grid fitted on a bounded sample of the distinct vectors."""
    total, labels, most = distinct.agg(
        F.count("*"), F.count_distinct("label"), F.max(F.octet_length("vec"))
    ).first()
    if not total:
        return None
    dims = most // kind.itemsize
    dims += dims % 2
    codes = min(MOST_CODES, int(np.ceil(np.sqrt(total / labels / CELL_VECTORS))))
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
    sample = bounded_sample(distinct.select("key", "vec"), rows, "key").toArrow()
    return fitted(padded(sample.column("vec").to_pylist(), kind, dims), codes, threshold, recall)


UNIT = "label string, cell int, low int, high int"


def links(
    distinct: DataFrame, grid: Grid, kind: np.dtype, threshold: float, block: int
) -> DataFrame:
    """``key``, ``root`` of its connected set and ``links``, once for each block where it has some."""
    spark = distinct.sparkSession
    sent = spark.sparkContext.broadcast(grid)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                raw = part.column("vec").to_pylist()
                found = cells(sent.value, padded(raw, kind, sent.value.dims))
                yield part.append_column("cells", pa.array(found, pa.list_(pa.int32())))

    placed = written(
        distinct.mapInArrow(
            place, "key binary, label string, vec binary, copies bigint, cells array<int>"
        ),
        "cells",
    )
    # In a cell the residents have visits 0 and the visitors 1.
    stays = placed.select(
        "key", "label", "copies", "vec", F.posexplode("cells").alias("place", "cell")
    ).withColumn("visits", F.col("place") > 0)
    sizes = stays.groupBy("label", "cell").agg(
        F.count_if(~F.col("visits")).alias("residents"), F.count_if("visits").alias("visitors")
    )
    sizes = sizes.where("residents > 0 AND residents + visitors > 1").select(
        "label",
        "cell",
        F.ceil(F.col("residents") / block).cast("int").alias("r"),
        F.ceil(F.col("visitors") / block).cast("int").alias("v"),
    )
    # Blocks 0 to r - 1 are the residents', the others the visitors'.
    mine = F.expr("int(IF(visits, r + pmod(xxhash64(key), v), pmod(xxhash64(key), r)))")
    others = F.expr("IF(visits, sequence(0, r - 1), sequence(0, r + v - 1))")
    units = (
        stays.join(sizes, ["label", "cell"])
        .withColumn("mine", mine)
        .withColumn("other", F.explode(others))
        .selectExpr(
            "label", "cell", "least(mine, other) low", "greatest(mine, other) high",
            "mine", "key", "copies", "vec",
        )
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("label", "cell", "low", "high")

        def unit_of(batch: pa.RecordBatch) -> pa.Array:
            columns = (batch.column(c).to_pylist() for c in names)
            return pa.array([f"{c}/{a}/{b}/{n}" for n, c, a, b in zip(*columns)], pa.string())

        numbered = (b.append_column("unit", unit_of(b)) for b in batches)
        for _, rows in sorted_groups(numbered, "unit"):
            made = compared(rows, kind, threshold)
            if made is not None:
                yield made

    return written(
        units.repartition("label", "cell", "low", "high")
        .sortWithinPartitions("label", "cell", "low", "high")
        .mapInArrow(compare, "key binary, root binary, links bigint"),
        "links",
    )


def compared(rows: pa.Table, kind: np.dtype, threshold: float) -> pa.RecordBatch | None:
    """Links of one unit: a block of a cell with itself or with another block."""
    keys = rows.column("key").to_pylist()
    if len(keys) < 2:
        return None
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys = [keys[i] for i in order]
    raw = rows.column("vec").to_pylist()
    raw = [raw[i] for i in order]
    lengths = np.array([len(r) for r in raw])
    copies = np.array(rows.column("copies").to_pylist(), np.int64)[order]
    side = np.array(rows.column("mine").to_pylist())[order]
    apart = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
    vectors = padded(raw, kind, int(lengths.max()) // kind.itemsize)
    n = len(keys)
    count, root = np.zeros(n, np.int64), np.arange(n)
    for begin in range(0, n, 512):
        part = slice(begin, min(begin + 512, n))
        near = vectors[part] @ vectors.T >= threshold
        near &= lengths[part, None] == lengths[None, :]
        if apart:
            near &= side[part, None] != side[None, :]
        near[np.arange(near.shape[0]), np.arange(part.start, part.stop)] = False
        count[part] = near @ copies
        for i in np.flatnonzero(near.any(axis=1)):
            # The set of i and those of its neighbours become one, named by the smallest member.
            names = np.unique(np.append(root[near[i]], root[begin + i]))
            if len(names) > 1:
                root[np.isin(root, names)] = names[0]
    found = np.flatnonzero(count)
    if not len(found):
        return None
    return pa.RecordBatch.from_arrays(
        [
            pa.array([keys[i] for i in found], pa.binary()),
            pa.array([keys[root[i]] for i in found], pa.binary()),
            pa.array(count[found], pa.int64()),
        ],
        ["key", "root", "links"],
    )


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id of the connected vectors)."""
    kind = np.dtype(np.float64 if "double" in dict(vectors.dtypes)[embedding] else np.float32)
    rows = written(serialised(vectors, vec_id, embedding, label), "vectors")
    # Ids that are NULL come last; of a component of such only, the id is NULL.
    distinct = written(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.first("label").alias("label"),
            F.first("vec").alias("vec"),
            F.min("id").alias("rep"),
            F.count("*").alias("copies"),
        ),
        "distinct-vectors",
    )
    grid = fit(distinct, kind, threshold, recall)
    if grid is None:
        alone = rows.select(F.col("id"), F.lit(0).cast("bigint"), F.col("id"))
        return alone.toDF(vec_id, "n_links", "component_id")
    found = links(
        distinct.select("key", "label", "vec", "copies"), grid, kind, threshold, block
    )
    counted = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found, "key", "root").withColumnRenamed("node", "key")
    classes = written(
        distinct.select("key", "rep", "copies")
        .join(roots, "key", "left")
        .join(counted, "key", "left")
        .selectExpr(
            "key", "rep", "coalesce(root, key) AS root", "coalesce(links, 0) + copies - 1 AS n_links"
        ),
        "vector-classes",
    )
    tops = classes.groupBy("root").agg(F.min("rep").alias("top"))
    classes = classes.join(tops, "root").select("key", "n_links", "top")
    joined = rows.select("id", "key").join(classes, "key", "left")
    return joined.select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("top")).alias("component_id"),
    )
