"""Embedding near-duplicates by spherical k-means cells and blocked cosine products.

Centroids are trained on a sample: ``CELLS`` times the square root of the number of
distinct vectors, ``SAMPLE`` vectors for each. Every vector is then assigned to its cells,
the ``PROBES`` nearest of those that can hold a partner at all: a vector within the angle of
the threshold can only lie beyond the plane between two centroids if the gap of the
products does not exceed the sine of that angle times the distance of the centroids. Two
vectors are compared, by blocks of exact double precision products, in the first cell that
both have. Random pairs at the threshold miss each other in all cells with a probability
below one in a thousand; the tests measure it.

Dense groups stay cheap. Equal vectors are one vertex with a weight. Vectors within half
the angle of the centroid of their nearest cell form its ball: all of a ball are linked by
the triangle inequality, so they are counted, not compared. What remains of a crowded cell
is cut into parts of ``PART`` vectors, and pairs of parts are tasks of their own.

Nulls and odd input: vectors that are null, empty, zero or hold null or non-finite numbers
link with nothing, stand for themselves and are kept. Vectors of different lengths link with
nothing of each other. A null vec_id keeps its row and is never ``kept``; component ids are
the smallest non-null vec_id. Repeated rows and equal vectors link with each other. Empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.components import components
from pricewatch.session import written

LEAST = 0.9
#: Cells a vector is compared in, at most.
PROBES = 8
#: Centroids for each square root of the distinct vectors, up to MAX_CELLS, which bounds what is broadcast.
CELLS = 2
MAX_CELLS = 1 << 15
#: Sampled vectors for each centroid, and rounds of training.
SAMPLE, ROUNDS = 32, 3
#: Centroids closer than this cosine are one: they would share a group of near copies.
SAME_CELL = 0.8
#: Vectors of a cell that one task compares with each other.
PART = 2048
_TILE = 512
_SINE = math.sqrt(1 - LEAST * LEAST)
#: Cosine of half the angle, with room for rounding.
_BALL = math.cos(math.acos(LEAST) / 2) + 1e-9


def _valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _digests(v: Column) -> list[Column]:
    return [F.xxhash64(v).alias("d1"), F.xxhash64(F.lit(1), F.reverse(v), v).alias("d2")]


def _unit(column, width: int) -> np.ndarray:
    """Rows of unit vectors from lists of numbers, padded with zeros to the width."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype("f8")
    size = np.diff(lists.offsets.to_numpy())
    at = np.repeat(np.arange(len(size)), size)
    out = np.zeros((len(size), width))
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    out /= np.abs(out).max(1, initial=0, keepdims=True)  # squares must not overflow
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _thinned(centroids: np.ndarray) -> np.ndarray:
    """The centroids without those too close to an earlier one."""
    kept = np.empty((0, centroids.shape[1]))
    for at in range(0, len(centroids), _TILE):
        block = centroids[at : at + _TILE]
        block = block[(block @ kept.T < SAME_CELL).all(1)]
        near = np.tril(block @ block.T >= SAME_CELL, -1)
        fine = np.zeros(len(block), bool)
        for i in range(len(block)):
            fine[i] = not (near[i] & fine).any()
        kept = np.concatenate([kept, block[fine]])
    return kept


def _partial_sums(centroids, width: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centroids.value), width)), np.zeros(len(centroids.value), np.int64)
        for batch in batches:
            x = _unit(batch.column(0), width)
            cell = (x @ centroids.value.T).argmax(1)
            np.add.at(total, cell, x)
            count += np.bincount(cell, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([s.tobytes() for s in total[some]], pa.binary())], ["cell", "sum"])

    return sums


def _mean_direction(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(s) for s in rows["sum"]], axis=0)
    length = np.linalg.norm(total)
    return pd.DataFrame({"cell": [key[0]], "sum": [(total / length if length else total).tobytes()]})


def train(vectors: DataFrame, count: int, width: int) -> np.ndarray:
    """Centroids of the vectors (column ``v``), fitted on a sample that grows with the square root of the table."""
    spark = vectors.sparkSession
    wanted = min(MAX_CELLS, max(1, math.ceil(CELLS * math.sqrt(count))))
    share = min(1.0, SAMPLE * wanted / max(count, 1))
    place = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    sample = written(vectors.select("v", place.alias("place")).where(F.col("place") < share * (1 << 30)), "sampled-vectors")
    first = sample.orderBy("place", "v").limit(wanted).select("v").toPandas()["v"]
    if first.empty:
        return np.empty((0, width))
    centroids = _thinned(_unit(pa.array([list(v) for v in first], pa.list_(pa.float64())), width))
    dealt = sample.select("v").repartition(max(1, min(spark.sparkContext.defaultParallelism, wanted // 64 + 1)))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(centroids)
        sums = dealt.mapInArrow(_partial_sums(shared, width), "cell long, sum binary")
        means = sums.groupBy("cell").applyInPandas(_mean_direction, "cell long, sum binary").orderBy("cell").toPandas()
        centroids = np.stack([np.frombuffer(s) for s in means["sum"]])
        shared.unpersist()
    return _thinned(centroids[np.linalg.norm(centroids, axis=1) > 0])


def _assignment(centroids, width: int) -> Callable:
    """Adds ``cells``, nearest first, and ``ball``: whether the vector lies in the ball of the first one."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        m = min(PROBES, len(c))
        for batch in batches:
            cells, ball = [], []
            for at in range(0, len(batch), 1024):
                near = _unit(batch.column(batch.schema.get_field_index("v")).slice(at, 1024), width) @ c.T
                top = np.argpartition(-near, m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(m), (len(near), 1))
                value = np.take_along_axis(near, top, 1)
                order = np.lexsort((top, -value), axis=1)
                top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
                apart = np.linalg.norm(c[top] - c[top[:, :1]], axis=2)
                fits = value[:, :1] - value <= _SINE * apart + 1e-9
                cells += [t[f].astype("i4") for t, f in zip(top, fits, strict=True)]
                ball.append(value[:, 0] >= _BALL)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(np.concatenate(ball) if ball else [], pa.bool_())],
                [*batch.schema.names, "cells", "ball"],
            )

    return assign


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from every value to the smallest of its component."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return values[root != np.arange(len(values))], values[root[root != np.arange(len(values))]]
        root = new


def _compared(width: int) -> Callable:
    """Links of one task: with one part, its vectors with each other, else those of the first part with those of the second."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell, i, j = key
        x = _unit(pa.array(rows["v"], pa.list_(pa.float64())), width)
        cells = np.full((len(rows), PROBES), -1, np.int64)
        for at, c in enumerate(rows["cells"]):
            cells[at, : len(c)] = np.sort(c)
        size, home = rows["size"].to_numpy(), rows["home"].to_numpy()
        ids, weight, part = rows["key"].to_numpy(), rows["w"].to_numpy(), rows["part"].to_numpy()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        count = np.zeros(len(rows), np.int64)
        ends_a, ends_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for p in range(0, len(left), _TILE):
            a = left[p : p + _TILE]
            for q in range(p if i == j else 0, len(right), _TILE):
                b = right[q : q + _TILE]
                s, t = np.nonzero(x[a] @ x[b].T >= LEAST)
                s, t = a[s], b[t]
                keep = (size[s] == size[t]) & ((home[s] < 0) | (home[s] != home[t]))
                if i == j:
                    keep &= s < t
                s, t = s[keep], t[keep]
                first = np.full(len(s), np.iinfo(np.int64).max)
                for k in range(PROBES):  # the first cell of both, in number order
                    c = cells[s, k]
                    both = (c >= 0) & (cells[t] == c[:, None]).any(1)
                    first = np.where(both, np.minimum(first, c), first)
                s, t = s[first == cell], t[first == cell]
                np.add.at(count, s, weight[t])
                np.add.at(count, t, weight[s])
                u, v = _forest(ids[s], ids[t])
                ends_a.append(u)
                ends_b.append(v)
        u, v = _forest(np.concatenate(ends_a), np.concatenate(ends_b))
        some = count > 0
        n = int(some.sum())
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[some], u]),
                "b": pd.array(np.concatenate([np.zeros(n, np.int64), v]), "Int64"),
                "n": pd.array(np.concatenate([count[some], np.zeros(len(u), np.int64)]), "Int64"),
                "link": np.concatenate([np.zeros(n, bool), np.ones(len(u), bool)]),
            }
        )

    return compare


def _tasks(assigned: DataFrame) -> DataFrame:
    """Every vector once for each task (cell, i, j) that compares it, with the part it is there."""
    home = F.when(F.col("ball"), F.col("cells")[0]).otherwise(-1).alias("home")
    members = assigned.select("key", "w", "v", "size", "cells", home, F.explode("cells").alias("cell"))
    in_ball = F.col("home") == F.col("cell")
    sizes = members.groupBy("cell").agg(F.count("*").alias("n"), F.count_if(in_ball).alias("n_ball"))
    # Parts below ``open`` hold the rest of a cell, those from there on its ball. One row a cell, at most MAX_CELLS.
    parts = sizes.where((F.col("n") > 1) & (F.col("n") > F.col("n_ball"))).select(
        "cell",
        F.when(F.col("n") > PART, F.ceil((F.col("n") - F.col("n_ball")) / PART)).otherwise(1).cast("int").alias("open"),
        F.when(F.col("n") > PART, F.ceil(F.col("n_ball") / PART)).otherwise(0).cast("int").alias("closed"),
    )
    parts = written(parts, "cell-parts")
    placed = members.join(F.broadcast(parts), "cell")
    turn = F.xxhash64("key")
    own = F.when(
        in_ball & (F.col("closed") > 0), F.col("open") + F.pmod(turn, F.greatest("closed", F.lit(1)))
    ).otherwise(F.pmod(turn, F.col("open")))
    placed = placed.withColumn("part", own.cast("int"))
    last = F.when(F.col("part") >= F.col("open"), F.col("open")).otherwise(F.col("open") + F.col("closed")) - 1
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        "key", "w", "v", "size", "cells", "home", "part",
    )


def grouped(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = rows.sparkSession
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).withColumn("valid", _valid(F.col("v")))
    valid = rows.where("valid")
    # Negative zeros compare as zeros, so they are written as such.
    plain = F.transform("v", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    valid = valid.select("vec_id", plain.alias("v"))
    distinct = valid.groupBy("v").agg(F.count("*").alias("w"), F.min("vec_id").alias("low"))
    distinct = distinct.select("v", "w", "low", F.size("v").alias("size"), *_digests(F.col("v")))
    distinct = written(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct-vectors")
    seen = distinct.agg(F.count("*").alias("n"), F.max("size").alias("width")).first()
    width = seen["width"] or 1
    shared = spark.sparkContext.broadcast(train(distinct.select("v"), seen["n"], width))
    kind = dict(distinct.dtypes)["v"]
    assigned = written(
        distinct.select("key", "w", "v", "size").mapInArrow(
            _assignment(shared, width), f"key long, w long, v {kind}, size int, cells array<int>, ball boolean"
        ),
        "vector-cells",
    )
    found = _tasks(assigned).groupBy("cell", "i", "j").applyInPandas(_compared(width), "a long, b long, n long, link boolean")
    found = written(found, "vector-links")
    # Balls of vectors of one length; one row a cell and length, so at most MAX_CELLS for each length in use.
    balls = assigned.where("ball").select("key", "w", "size", F.col("cells")[0].alias("cell"))
    whole = balls.groupBy("cell", "size").agg(F.sum("w").alias("all_w"), F.min("key").alias("first"))
    balls = written(balls.join(whole, ["cell", "size"]), "vector-balls")
    links = found.where("link").select("a", "b").union(balls.where("key <> first").select("key", "first"))
    roots = components(links, "a", "b").withColumnRenamed("vertex", "key")
    counts = found.where("NOT link").select(F.col("a").alias("key"), "n").union(
        balls.select("key", F.col("all_w") - F.col("w"))
    ).groupBy("key").agg(F.sum("n").alias("n"))
    known = distinct.drop("v", "size").join(counts, "key", "left").join(roots, "key", "left")
    known = written(known.withColumn("root", F.coalesce("root", "key")), "vector-roots")
    ids = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(ids, "root").select(
        "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id"
    )
    known = written(known, "vector-components")
    linked = valid.select("vec_id", *_digests(F.col("v"))).join(known, ["d1", "d2"])
    alone = rows.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").union(alone)
    return every.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
