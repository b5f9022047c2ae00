"""Conversation prefix trie: every shared or own prefix of turns as a node, with its members and savings.

A prefix is known by 128 bits: the exclusive or of its turns' hashes, each salted with its
depth, so prefixes are running values that long conversations carry from chunk to chunk.

A count-min sketch of all prefix digests screens them. It holds two bits a cell, enough to
tell one from more. A digest with a cell of count one is in one conversation only, and so
is every longer prefix of it: such a tail is emitted where it stands, as a chain of nodes
of one member. Only prefixes that may be shared are shuffled, and grouped exactly. The
sketch grows with the number of prefixes up to ``MAX_CELLS`` cells a row, which bounds what
is broadcast; beyond that more prefixes go the exact way, and results stay the same.

No conversation and no node is held whole by a task. Turns are sorted by range and cut into
chunks; nodes are counted with map-side combination; sums over subtrees run along the
conversation of each node's smallest member, in blocks; the members that end at a node are
joined in sorted runs, and only their running digest passes from run to run.

Nulls and odd input: rows without conv_id are ignored; a null role or text is empty. Turns
of equal number, also null ones, which come first, stand in the order of a hash of role and
text, and repeated rows are turns of their own. Empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.columns import n_words, numbered
from pricewatch.operators.ordered import running_total
from pricewatch.session import written

#: Conversations whose first turns are taken over come every so many ids, and up to so many turns are taken.
EVERY, TAKEN = 20, 4
#: Turns of a chunk, at most.
CHUNK = 4096
#: Cells a row of the sketch for each prefix, the least and the greatest number, and the cells of a block.
CELLS, MIN_CELLS, MAX_CELLS, BLOCK = 4, 1 << 16, 1 << 27, 1 << 16
#: Members that one run joins.
RUN = 4096
#: Parents with more than this share of all children are met by a broadcast of at most as many rows.
HOT = 1000
_NONE = hashlib.sha256(b"").hexdigest()


def _salted(turn: np.ndarray, depth: np.ndarray, seed: int) -> np.ndarray:
    """Turn hashes mixed with their depth, as unsigned numbers."""
    x = turn ^ (depth.astype("u8") + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to chunks of one conversation."""
    for batch in batches:
        if not len(batch):
            continue
        conv = batch.column(0).to_numpy()
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        start = np.flatnonzero(new)
        place = np.arange(len(conv)) - np.repeat(start, np.diff(np.append(start, len(conv))))
        start = np.flatnonzero(place % CHUNK == 0)
        ends = np.append(start, len(conv)).astype("i4")
        turns = pa.StructArray.from_arrays(batch.columns[2:5], ["h1", "h2", "w"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(start)), batch.column(1).take(pa.array(start)), pa.array(np.diff(ends).astype("i8")),
             pa.ListArray.from_arrays(pa.array(ends), turns)],
            ["c", "at", "n", "turns"],
        )


_TURNS = "array<struct<h1:long,h2:long,w:long>>"


def _rebuilt(conversations: DataFrame) -> DataFrame:
    """(c, start, x1, x2, last, turns) by chunk: rebuilt conversations, the depth and digest before the chunk, and the depth of the whole."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    turns = numbered(conversations.select("conv_id", "turn", "role", "text"), "__row").where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"),
        F.struct("turn", F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"), "__row").alias("at"),
        n_words(text).alias("w"),
    )
    turns = turns.select("c", "at", "at.h1", "at.h2", "w")
    at_type = turns.schema["at"].dataType.simpleString()
    dealt = turns.repartitionByRange("c", "at").sortWithinPartitions("c", "at")
    chunks = written(dealt.mapInArrow(_cut, f"c long, at {at_type}, n long, turns {_TURNS}"), "chunks")

    # Chunk numbers and sizes are small rows: a conversation has one of them, or one for thousands of turns.
    of_conv = Window.partitionBy("c")
    earlier = of_conv.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select(
        "c", "at",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
        F.sum("n").over(of_conv).alias("total"),
    )
    placed = written(chunks.join(places, ["c", "at"]).select("c", "first", "total", "n", "turns"), "placed-chunks")

    heads = placed.where(F.col("first") < TAKEN - 1).select("c", "first", F.posexplode(F.slice("turns", 1, TAKEN - 1)).alias("i", "turn"))
    heads = heads.where(F.col("first") + F.col("i") < TAKEN - 1).groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct((F.col("first") + F.col("i")).alias("i"), "turn"))).alias("head")
    )
    head = F.transform("head", lambda t: t["turn"]).alias("head")
    taken = (F.crc32(F.col("c").cast("string")) % TAKEN).cast("int")
    convs = heads.select("c", taken.alias("h"), (F.col("c") - F.col("c") % EVERY).alias("donor"))
    donors = heads.select(F.col("c").alias("donor"), head)
    convs = convs.join(donors, "donor", "left").select(
        "c", "h", F.slice(F.coalesce("head", F.expr(f"CAST(array() AS {_TURNS})")), F.lit(1), F.col("h")).alias("head")
    )
    drop = F.greatest(F.lit(0), F.least(F.col("h") - F.col("first"), F.col("n"))).cast("int")
    own = F.slice("turns", drop + 1, F.greatest(F.lit(0), F.size("turns") - drop))
    k = F.size("head")
    made = placed.join(convs, "c").select(
        "c",
        F.when(F.col("first") == 0, 0).otherwise(k + F.greatest(F.col("first"), F.col("h")) - F.col("h")).cast("long").alias("start"),
        (k + F.greatest(F.lit(0), F.col("total") - F.col("h"))).cast("long").alias("last"),
        F.when(F.col("first") == 0, F.concat("head", own)).otherwise(own).alias("turns"),
        F.col("first") == 0,
    )
    made = made.toDF("c", "start", "last", "turns", "opens").where("opens OR size(turns) > 0")
    made = written(made.mapInArrow(_digested, f"c long, start long, last long, opens boolean, y1 long, y2 long, turns {_TURNS}"), "digested-chunks")
    before = of_conv.orderBy(F.desc("opens"), "start").rowsBetween(Window.unboundedPreceding, -1)
    many = made.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c")
    carry = made.select("c", "opens", "start", "y1", "y2").join(many, "c", "left_semi").select(
        "c", "opens", "start", F.expr("bit_xor(y1)").over(before).alias("x1"), F.expr("bit_xor(y2)").over(before).alias("x2")
    )
    carried = made.join(carry, ["c", "opens", "start"], "left").fillna(0, ["x1", "x2"])
    return written(carried.select("c", "opens", "start", "x1", "x2", "last", "turns"), "rebuilt")


def _flat(batch: pa.RecordBatch) -> tuple:
    """Chunk of each turn, its depth, and the hashes and words of a batch of chunks."""
    turns = batch.column(batch.schema.get_field_index("turns"))
    n = np.diff(turns.offsets.to_numpy())
    chunk = np.repeat(np.arange(len(n)), n)
    start = batch.column(batch.schema.get_field_index("start")).to_numpy()
    within = np.arange(len(chunk)) - np.repeat(np.cumsum(n) - n, n)
    h1, h2, w = turns.flatten().flatten()
    return n, chunk, start[chunk] + within + 1, h1.to_numpy().view("u8"), h2.to_numpy().view("u8"), w.to_numpy()


def _running(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Exclusive or up to each value, within chunks of n values."""
    total = np.concatenate([np.zeros(1, "u8"), np.bitwise_xor.accumulate(values)]) if len(values) else np.zeros(1, "u8")
    return total[1:] ^ np.repeat(total[np.cumsum(n) - n], n)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running digests within each chunk in place of turn hashes, and the digest of the whole chunk."""
    for batch in batches:
        n, _, depth, h1, h2, w = _flat(batch)
        columns, last = [], np.cumsum(n) - 1
        for h, seed in ((h1, 1), (h2, 2)):
            run = _running(_salted(h, depth, seed), n)
            columns.append((run, np.where(n > 0, run[np.maximum(last, 0)] if len(run) else 0, 0).astype("u8")))
        turns = pa.StructArray.from_arrays([pa.array(columns[0][0].view("i8")), pa.array(columns[1][0].view("i8")), pa.array(w)], ["h1", "h2", "w"])
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype("i4"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), batch.column(4), *(pa.array(y.view("i8")) for _, y in columns),
             pa.ListArray.from_arrays(ends, turns)],
            ["c", "start", "last", "opens", "y1", "y2", "turns"],
        )


def _nodes(batch: pa.RecordBatch) -> tuple:
    """The prefixes of a batch of chunks, the root with the first chunk: chunk, depth, digests, parent digests, words."""
    n, chunk, depth, h1, h2, w = _flat(batch)
    x1, x2 = (batch.column(batch.schema.get_field_index(c)).to_numpy().view("u8") for c in ("x1", "x2"))
    g1, g2 = h1 ^ x1[chunk], h2 ^ x2[chunk]
    first = np.ones(len(chunk), bool)
    first[1:] = chunk[1:] != chunk[:-1]
    p1, p2 = np.where(first, x1[chunk], np.roll(g1, 1)), np.where(first, x2[chunk], np.roll(g2, 1))
    opens = np.flatnonzero(batch.column(batch.schema.get_field_index("opens")).to_numpy(zero_copy_only=False))
    zero = np.zeros(len(opens), "u8")
    parts = [(opens, zero.astype("i8"), zero, zero, zero, zero, zero.astype("i8")), (chunk, depth, g1, g2, p1, p2, w)]
    chunk, depth, g1, g2, p1, p2, w = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((depth, chunk))
    return tuple(x[order] for x in (chunk, depth, g1, g2, p1, p2, w))


def _partial_sketch(cells: int) -> Callable:
    """Per block of cells, which cells a task has met once and more often."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = [[], []]
        for batch in batches:
            _, _, g1, g2, *_ = _nodes(batch)
            for row, g in enumerate((g1, g2)):
                cell, n = np.unique(g % np.uint64(cells), return_counts=True)
                met[row].append(np.concatenate([cell, cell[n > 1]]).astype("u4"))
        for row in (0, 1):
            if not met[row]:
                continue
            cell, n = np.unique(np.concatenate(met[row]), return_counts=True)
            cell = np.sort(np.concatenate([cell, cell[n > 1]]))  # twice at most
            block, start = np.unique(cell // BLOCK, return_index=True)
            parts = np.split((cell % BLOCK).astype("u2"), start[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(block), row, "i4")), pa.array(block.astype("i4")), pa.array([x.tobytes() for x in parts], pa.binary())],
                ["row", "block", "met"],
            )

    return sketch


def _merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The bits of the cells of a block that were met more than once."""
    count = np.zeros(BLOCK, np.uint8)
    for met in rows["met"]:
        count = np.minimum(count + np.bincount(np.frombuffer(met, "u2"), minlength=BLOCK), 2).astype(np.uint8)
    return pd.DataFrame({"row": [key[0]], "block": [key[1]], "bits": [np.packbits(count > 1, bitorder="little").tobytes()]})


def sketched(chunks: DataFrame) -> tuple[int, np.ndarray]:
    """Cells a row, and for both rows the bits of cells that count more than one prefix."""
    prefixes = chunks.agg(F.sum(F.size("turns") + F.col("opens").cast("int"))).first()[0] or 0
    cells = min(MAX_CELLS, max(MIN_CELLS, 1 << (CELLS * prefixes).bit_length()))
    partial = chunks.mapInArrow(_partial_sketch(cells), "row int, block int, met binary")
    bits = np.zeros((2, cells // 8), np.uint8)
    for row in partial.groupBy("row", "block").applyInPandas(_merged, "row int, block int, bits binary").toLocalIterator():
        bits[row["row"], row["block"] * (BLOCK // 8) : (row["block"] + 1) * (BLOCK // 8)] = np.frombuffer(row["bits"], np.uint8)
    return cells, bits


OPEN, HEAD, TAIL = 0, 1, 2


def _screened(cells: int, sketch) -> Callable:
    """Every prefix with its kind: possibly shared, first of a tail, or in a tail."""

    def single(g1: np.ndarray, g2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(g1), bool)
        for bits, g in zip(sketch.value, (g1, g2), strict=True):
            cell = g % np.uint64(cells)
            out |= (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 0
        return out

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, depth, g1, g2, p1, p2, w = _nodes(batch)
            if not len(chunk):
                continue
            new = np.ones(len(chunk), bool)
            new[1:] = chunk[1:] != chunk[:-1]
            after = single(p1, p2) & (depth > 0)  # the parent is proven single
            proven = single(g1, g2) | (after & new)
            # From the first proven prefix of a chunk on, all are.
            sums = np.cumsum(proven)
            before = (sums - proven)[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            earlier = sums - proven - before > 0
            kind = np.where(earlier | (after & new), TAIL, np.where(proven, HEAD, OPEN))
            c, last = (batch.column(batch.schema.get_field_index(x)).to_numpy()[chunk] for x in ("c", "last"))
            names = ["kind", "c", "depth", "g1", "g2", "p1", "p2", "w", "ends"]
            values = [kind.astype("i4"), c, depth, *(x.view("i8") for x in (g1, g2, p1, p2)), w, depth == last]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)

    return screen


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members sorted by node to runs of joined ids."""
    for batch in batches:
        g1, g2, c = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(c), bool)
        new[1:] = (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])
        start = np.flatnonzero(new)
        place = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
        start = np.flatnonzero(place % RUN == 0)
        text = c.astype(str)
        ids = [",".join(part) for part in np.split(text, start[1:])] if len(c) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(g1[start]), pa.array(g2[start]), pa.array(c[start]), pa.array(ids, pa.string())], ["g1", "g2", "c", "ids"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by node and first member to one digest for each node."""
    node, state = None, None
    for batch in batches:
        out = []
        for g1, g2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if node == (g1, g2):
                state.update(b"," + ids.encode())
                continue
            if node:
                out.append((*node, state.hexdigest()))
            node, state = (g1, g2), hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(("g1", "g2", "ends_sha256"), row, strict=True)) for row in out], _HASHED)
    if node:
        yield pa.RecordBatch.from_pylist([{"g1": node[0], "g2": node[1], "ends_sha256": state.hexdigest()}], _HASHED)


_HASHED = pa.schema([("g1", pa.int64()), ("g2", pa.int64()), ("ends_sha256", pa.string())])
_NODE = ["g1", "g2"]
_PARENT = ["p1", "p2"]


def _with_parent(rows: DataFrame, nodes: DataFrame, hot: DataFrame) -> DataFrame:
    """Adds ``parent_conv_id`` of the parent node, null where that is no shared node."""
    near = rows.join(F.broadcast(hot.toDF("p1", "p2", "hot_conv_id")), _PARENT, "left")
    warm = near.where("hot_conv_id IS NOT NULL").withColumnRenamed("hot_conv_id", "parent_conv_id")
    cold = near.where("hot_conv_id IS NULL").drop("hot_conv_id")
    parents = nodes.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return warm.unionByName(cold.join(parents, _PARENT, "left"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    chunks = _rebuilt(conversations)
    cells, bits = sketched(chunks)
    kinds = "kind int, c long, depth long, g1 long, g2 long, p1 long, p2 long, w long, ends boolean"
    screened = written(chunks.mapInArrow(_screened(cells, spark.sparkContext.broadcast(bits)), kinds), "screened")
    shared, heads, tails = (screened.where(F.col("kind") == k) for k in (OPEN, HEAD, TAIL))

    # Equal digests have equal depth, words and parents, so any of them serves.
    nodes = shared.groupBy(*_NODE).agg(
        F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.max("depth").alias("depth"), F.max("w").alias("w"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    nodes = written(nodes, "shared-nodes")
    below = nodes.where("depth > 0").select(*_PARENT).union(heads.where("depth > 0").select(*_PARENT))
    children = below.groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, _NODE, "left").fillna(0, ["n_children"]), "nodes-with-children")

    # What each node adds to its subtree stands with its smallest member; a tail has one leaf.
    own = nodes.select(
        F.col("conv_id").alias("c"), "depth", ((F.col("n_convs") - 1) * F.col("w")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")
    ).where("saved > 0 OR leaf > 0")
    own = own.union(heads.select("c", "depth", F.lit(0).cast("long"), F.lit(1).cast("long")))
    leaf = own.where("leaf > 0").groupBy("c").agg(F.max("depth").alias("depth"))
    added = own.where("saved > 0").select("c", "depth", "saved", F.lit(0).cast("long").alias("leaf")).union(
        leaf.select("c", "depth", F.lit(0).cast("long"), F.lit(1).cast("long"))
    )
    added = written(added, "added")
    zero = F.lit(0).cast("long")
    path = shared.join(added.select("c").distinct(), "c", "left_semi").select(
        "c", (-2 * F.col("depth")).alias("place"), "g1", "g2", zero.alias("saved"), zero.alias("leaf")
    )
    missing = F.lit(None).cast("long")
    events = path.union(added.select("c", -2 * F.col("depth") - 1, missing, missing, "saved", "leaf"))
    events = running_total(running_total(events, ["c"], "place", "saved", "saved_tokens"), ["c"], "place", "leaf", "n_leaves")
    sums = events.where("g1 IS NOT NULL").groupBy(*_NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))

    members = shared.where("ends").select(*_NODE, "c").repartitionByRange(*_NODE, "c").sortWithinPartitions(*_NODE, "c")
    runs = members.mapInArrow(_runs, "g1 long, g2 long, c long, ids string")
    ends = runs.repartition(*_NODE).sortWithinPartitions(*_NODE, "c").mapInArrow(_hashed, "g1 long, g2 long, ends_sha256 string")

    most = nodes.agg(F.sum("n_children")).first()[0] or 0
    hot = written(nodes.where(F.col("n_children") > most / HOT).select(*_NODE, "conv_id"), "hot-parents")
    whole = nodes.join(sums, _NODE, "left").join(ends, _NODE, "left").fillna(_NONE, ["ends_sha256"])
    whole = _with_parent(whole, nodes, hot).select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )

    def alone(parent: Column) -> list[Column]:
        one = F.lit(1).cast("long")
        digest = F.when(F.col("ends"), F.sha2(F.col("c").cast("string"), 256)).otherwise(_NONE)
        return [
            F.col("c").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(F.col("ends"), zero).otherwise(one).alias("n_children"),
            one.alias("n_leaves"), zero.alias("saved_tokens"), digest.alias("ends_sha256"),
        ]

    first = _with_parent(heads, nodes, hot).select(*alone(F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "c"))))
    return whole.union(first).union(tails.select(*alone(F.col("c"))))
