"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Two trie nodes of equal depth are visited together with the number of bits in which their
paths differ, and a pair of nodes is left as soon as that exceeds the error budget. Four
differing bits leave at most one in one of three blocks of the fingerprint, so the join
runs over three tries, each with another block first, and allows one error inside that
block and four below it: far fewer node pairs stay open than with one trie.

The top of a trie is spread over Spark: each fingerprint goes to its node at a depth that
grows with the table, and to the nodes one bit away. Every such node pair is then
traversed in a task. Nodes with many fingerprints are cut into chunks, and chunk pairs
are tasks of their own. A task returns a spanning forest of the links it finds, so a dense
group of near copies gives one link per text and no text loses its last link.

Nulls and odd input: a null or empty text has fingerprint zero, linked like any other. A
null doc_id keeps its row; component ids are the smallest non-null doc_id of a component,
null if there is none. Repeated rows share their component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pricewatch.llm.columns import numbered
from pricewatch.llm.components import components
from pricewatch.session import written

SHINGLE = 4
SEED = 42
BUDGET = 4
BLOCKS = ((0, 21), (21, 22), (43, 21))  # first bit and length
BLOCK_BUDGET = BUDGET // len(BLOCKS)
#: Fingerprints of a node that one task joins with each other.
CHUNK = 2048
#: Wanted fingerprints of a node at the depth where the trie is spread.
PER_NODE = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(g) for g in zip(*(w[i:] for i in range(shingle)), strict=False)] or [b" ".join(w)]
    return majority(np.array([xxh64_intdigest(g, SEED) for g in grams], "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as an unsigned number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((fingerprint(t) for t in texts), "u8", len(texts)).view("i8"))


def traverse(home: np.ndarray, other: np.ndarray | None, depth: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted fingerprints at most BUDGET bits apart; ``other`` None joins home with itself.

    From ``depth`` on, node pairs are ranges of both arrays with the bits they differ in so
    far; before that they differ in at most one bit, which the last comparison counts too.
    """
    same, other = other is None, home if other is None else other
    if not len(home) or not len(other):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    top = np.uint64(64 - depth)
    apart = 0 if depth == 0 or same else int(np.bitwise_count((home[0] ^ other[0]) >> top))
    nodes = np.array([[0, len(home), 0, len(other), apart]], np.int64)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []

    def compare(pairs: np.ndarray) -> None:
        """All pairs below the given small node pairs, in bounded slices."""
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        ends = np.cumsum(sizes)
        start = 0
        while start < len(pairs):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + 2_000_000, "right")))
            p, n = pairs[start:stop], sizes[start:stop]
            which = np.repeat(np.arange(len(p)), n)
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            width = (p[:, 3] - p[:, 2])[which]
            i, j = p[which, 0] + k // width, p[which, 2] + k % width
            near = np.bitwise_count(home[i] ^ other[j]) <= BUDGET
            if same:
                near &= i < j
            left.append(i[near])
            right.append(j[near])
            start = stop

    for bit in range(depth, 64):
        sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        small = sizes <= 64
        compare(nodes[small])
        nodes = nodes[~small]
        if not len(nodes):
            break
        mask = np.uint64(1 << (63 - bit))
        zeros_h = np.concatenate([[0], np.cumsum((home & mask) == 0)])
        zeros_o = np.concatenate([[0], np.cumsum((other & mask) == 0)])
        h0, h1, o0, o1, d = nodes.T
        hm, om = h0 + zeros_h[h1] - zeros_h[h0], o0 + zeros_o[o1] - zeros_o[o0]
        children = [
            np.stack([h0, hm, o0, om, d], 1),
            np.stack([hm, h1, om, o1, d], 1),
            np.stack([h0, hm, om, o1, d + 1], 1),
        ]
        crossed = np.stack([hm, h1, o0, om, d + 1], 1)
        if same:  # of a node with itself the two crossed pairs are one
            crossed = crossed[~((h0 == o0) & (h1 == o1))]
        nodes = np.concatenate([*children, crossed])
        budget = BLOCK_BUDGET if bit + 1 <= block else BUDGET
        nodes = nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= budget)]
    else:
        compare(nodes)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


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
            break
        root = new
    rest = root != np.arange(len(values))
    return values[rest], values[root[rest]]


def _rotated(fp: Column, first: int) -> Column:
    if first == 0:
        return fp
    return F.shiftleft(fp, first).bitwiseOR(F.shiftrightunsigned(fp, 64 - first))


def _task(depth: int):
    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        trie, a, b, i, j = key
        block = BLOCKS[trie][1]
        fps = rows.fp.to_numpy().view("u8")
        role = rows.role.to_numpy()
        home, visitors = np.sort(fps[role == 0]), fps[role == 1]
        found = []
        if a == b and i == j:
            x, y = traverse(home, None, depth, block)
            found.append((home[x], home[y]))
        # Visitors of one node share the bits above the depth.
        node = visitors >> np.uint64(64 - depth) if depth else np.zeros(len(visitors), "u8")
        for n in np.unique(node):
            other = np.sort(visitors[node == n])
            x, y = traverse(home, other, depth, block)
            found.append((home[x], other[y]))
        if not found or not sum(len(x) for x, _ in found):
            return pd.DataFrame({"trie": [], "a": [], "b": []}).astype("int64")
        x, y = _forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
        return pd.DataFrame({"trie": np.full(len(x), trie), "a": x.view("i8"), "b": y.view("i8")})

    return join


def near(fps: DataFrame, per_node: int = PER_NODE, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect the distinct values of the long column ``fp`` as all pairs within the budget do."""
    size = fps.count()
    depth = min(max(size // per_node, 1).bit_length() - 1, min(length for _, length in BLOCKS))
    tries = F.array(*(F.struct(F.lit(t).alias("trie"), _rotated(F.col("fp"), first).alias("fp")) for t, (first, _) in enumerate(BLOCKS)))
    node = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    members = fps.select(F.inline(tries)).withColumn("node", node)
    crowded = written(
        members.groupBy("trie", "node").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
        .select("trie", "node", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")),
        "crowded",
    )
    members = members.join(crowded, ["trie", "node"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    members = members.withColumn("part", part)

    def to(a, b, i, j, role) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), i.alias("i"), j.alias("j"), role.cast("int").alias("role"))

    own = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: to(F.col("node"), F.col("node"), F.least("part", c), F.greatest("part", c), F.col("part") > c),
    )
    sent = members.select("trie", "fp", F.inline(own))
    if depth:
        bits = F.array(*(F.lit(1 << k).cast("long") for k in range(depth)))
        beside = members.withColumn("bit", F.explode(bits)).withColumn("beside", F.col("node").bitwiseXOR(F.col("bit")))
        beside = beside.join(
            crowded.select("trie", F.col("node").alias("beside"), F.col("chunks").alias("their_chunks")), ["trie", "beside"], "left"
        ).withColumn("their_chunks", F.coalesce("their_chunks", F.lit(1)))
        first = F.col("node") < F.col("beside")
        light = (F.col("chunks") == 1) & (F.col("their_chunks") == 1)
        visits = F.when(
            light, F.array(to(F.col("beside"), F.col("beside"), F.lit(0), F.lit(0), F.lit(1)))
        ).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.col("their_chunks") - 1),
                lambda c: to(
                    F.least("node", "beside"), F.greatest("node", "beside"),
                    F.when(first, F.col("part")).otherwise(c), F.when(first, c).otherwise(F.col("part")), ~first,
                ),
            )
        )
        sent = sent.union(beside.where(~light | ~first).select("trie", "fp", F.inline(visits)))
    found = sent.groupBy("trie", "a", "b", "i", "j").applyInPandas(_task(depth), "trie long, a long, b long")

    def back(column: str) -> Column:
        value = F.lit(None).cast("long")
        for t, (start, _) in enumerate(BLOCKS):
            value = F.when(F.col("trie") == t, _rotated(F.col(column), (64 - start) % 64)).otherwise(value)
        return value

    return found.select(back("a").alias("a"), back("b").alias("b")).distinct()


def grouped(documents: DataFrame, *keep: str) -> DataFrame:
    """The named columns, ``fp``, ``root`` (a fingerprint of the component) and ``component_id`` of every document."""
    rows = written(documents.select("doc_id", *(k for k in keep if k != "doc_id"), fingerprints("text").alias("fp")), "fingerprints")
    texts = written(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints")
    roots = components(near(texts.select("fp")), "a", "b")
    known = written(
        texts.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").select(
            "fp", "smallest", F.coalesce("root", "fp").alias("root")
        ),
        "roots",
    )
    ids = known.groupBy("root").agg(F.min("smallest").alias("component_id"))
    by_fp = written(known.join(ids, "root").select("fp", "root", "component_id"), "component-ids")
    return rows.join(by_fp, "fp")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """One document of each component: the smallest doc_id, nulls last, and of equal ones the first row."""
    rows = numbered(documents, "__row")
    groups = written(grouped(rows, "__row"), "near-duplicates")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("__row"))
    kept = groups.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.__row").alias("__kept"))
    dropped = written(groups.join(kept, F.col("__row") == F.col("__kept"), "left_anti").select("__row"), "dropped-rows")
    return rows.join(dropped, "__row", "left_anti").drop("__row")
