"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is wanted ``target / source_size`` times. The whole part is taken
outright; the rest is a copy probability. Pairs of fractional documents of one source
exchange probability, weighted by their sizes so that the expected words stay the same,
until one of the two is integral; the other goes on to the next pair. Blocks of documents
are reduced in parallel, and what each block leaves over (one document) is reduced again
in the next level of a tree, until one document for each source is left. Documents that
are large beside their source's target go first, and the others' probabilities make up for
what the large ones took too much or too little. So a source's words differ from its target
by less than one small document. Most of that is undone at the end: where another document
of about the missing (or surplus) size can be switched, it is.

Draws are hashes of the rows, so reruns agree. All of it is built-in column functions.
Source sizes, targets and counts are tables; the driver sees totals only, so any number of
sources and a source with most of the rows are fine (its blocks are as small as others').

Nulls and odd input: a null text has size 0, and documents of size 0 are taken 0 words. A
null source is a source of its own, last in order. Repeated rows are rounded each on their
own. Sources of total size 0 get target 0. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.columns import n_words, numbered
from pricewatch.session import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BLOCK = 64
#: Documents above this share of their source's target are rounded before the others.
LARGE = 0.005
#: How many documents of a source are switched at the end to come closer to its target.
SWITCHES = 3


def ranked(rows: DataFrame, key: str, partitions: int = 16) -> DataFrame:
    """The distinct rows of ``key`` with ``rank`` from 0 by code point, nulls last.

    Sorted in ranges; a rank is the place in the range plus the sizes of earlier ranges.
    """
    order = F.col(key).asc_nulls_last()
    sorted_rows = written(
        rows.repartitionByRange(partitions, order)
        .sortWithinPartitions(order)
        .select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__at")),
        "ranked",
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    starts = (
        sorted_rows.groupBy("__range")
        .agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
        .select("__range", "__first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    )
    return sorted_rows.join(F.broadcast(starts), "__range").select(
        *rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("rank")
    )


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size, ...).

    Sources share ``share`` of all words by weight. Those above ``most`` times their size
    stop there and the excess is shared again, until none is above.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(ranked(sources, "source").withColumn("weight", weight).drop("rank"), "sources")
    wanted = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("weight") * level > most * F.col("source_size")
        row = table.agg(
            F.sum(F.when(full, most * F.col("source_size"))).alias("stopped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not row.open:
            break
        raised = (wanted - float(row.stopped or 0)) / row.open
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return table.withColumn(
        "target", F.least(F.col("weight") * level, (most * F.col("source_size")).cast("double"))
    ).drop("weight")


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _reduce(items: Column, level: int) -> Column:
    """Pivotal rounding along an array of items: those decided and the one left over."""

    def step(acc: Column, b: Column) -> Column:
        a = acc["left"]
        # In words: either can give up p * size and take (1 - p) * size more.
        a_gives, a_takes = a["p"] * a["size"], (1 - a["p"]) * a["size"]
        b_gives, b_takes = b["p"] * b["size"], (1 - b["p"]) * b["size"]
        up, down = F.least(a_takes, b_gives), F.least(a_gives, b_takes)
        rises = F.coalesce(_draw(a["seed"], b["seed"], F.lit(level)) < F.try_divide(down, up + down), F.lit(False))
        fills, empties = a_takes <= b_gives, a_gives <= b_takes
        a_p = F.when(rises, F.when(fills, 1.0).otherwise(a["p"] + up / a["size"])).otherwise(
            F.when(empties, 0.0).otherwise(a["p"] - down / a["size"])
        )
        b_p = F.when(rises, F.when(fills, b["p"] - up / b["size"]).otherwise(0.0)).otherwise(
            F.when(empties, b["p"] + down / b["size"]).otherwise(1.0)
        )
        a_done = F.when(rises, fills).otherwise(empties)
        return F.when(
            a_done, F.struct(b.withField("p", b_p).alias("left"), F.array_append(acc["done"], a.withField("p", a_p)).alias("done"))
        ).otherwise(
            F.struct(a.withField("p", a_p).alias("left"), F.array_append(acc["done"], b.withField("p", b_p)).alias("done"))
        )

    first = F.struct(F.get(items, F.lit(0)).alias("left"), F.filter(items, lambda x: F.lit(False)).alias("done"))
    return F.aggregate(F.slice(items, F.lit(2), F.size(items)), first, step)


def _rounded(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """Sized rows with the target of their source, ``whole`` copies and ``bump`` (0 or 1 more)."""
    about = ["source_key", "source_size", "target"]
    ratio = F.least(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)), F.lit(float(MOST_COPIES)))
    whole = F.floor(ratio + 1e-12).cast("int")
    item = F.struct(
        "row", "doc_id", "size", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("p"),
        F.xxhash64("doc_id", "size", "source_key").alias("seed"),
    )
    every = rows.join(ratios.select(*about, "n"), "source_key").select(*about, "n", item.alias("item"))
    fractional = (F.col("item.p") > 1e-12) & (F.col("item.size") > 0)
    pieces = [every.where(~fractional).select(*about, F.col("item").withField("p", F.lit(0.0)).alias("item"))]
    blocks_of = F.ceil(F.col("n") / BLOCK)
    moving = every.where(fractional).select(
        *about, F.pmod(F.xxhash64(F.lit("block"), "item.seed", "item.row"), blocks_of).alias("block"), "item"
    )
    blocks, level = -(-(ratios.agg(F.max("n")).first()[0] or 1) // BLOCK), 0
    while True:
        in_order = F.sort_array(F.collect_list(F.struct(F.col("item.size").alias("size"), "item.seed", "item.row", "item")))
        reduced = written(
            moving.groupBy("source_key", "block")
            .agg(*(F.first(f).alias(f) for f in about[1:]), F.transform(in_order, lambda x: x["item"]).alias("items"))
            .select(*about, "block", _reduce(F.col("items"), level).alias("out")),
            f"mix-{level}",
        )
        pieces.append(reduced.select(*about, F.explode("out.done").alias("item")))
        moving = reduced.select(*about, F.floor(F.col("block") / BLOCK).alias("block"), F.col("out.left").alias("item"))
        if blocks <= 1:
            break
        blocks, level = -(-blocks // BLOCK), level + 1
    last = F.when(_draw(F.col("item.seed"), F.lit("last")) < F.col("item.p"), 1.0).otherwise(0.0)
    pieces.append(moving.select(*about, F.col("item").withField("p", last).alias("item")))
    together = pieces[0]
    for piece in pieces[1:]:
        together = together.unionByName(piece)
    return written(
        together.select(
            *about, "item.row", "item.doc_id", "item.size", "item.whole", F.col("item.p").cast("int").alias("bump"), "item.seed"
        ),
        "mix-rounded",
    )


def _switches(rounded: DataFrame) -> DataFrame:
    """Of each source, the row whose switch brings its words closest to the target, if any does."""
    words_taken = F.col("size") * (F.col("whole") + F.col("bump"))
    # Written, so that its size is known and a hot source is not dealt to one task.
    off = written(rounded.groupBy("source_key").agg((F.sum(words_taken) - F.first("target")).alias("off")), "mix-off")
    change = F.when(F.col("bump") == 1, -F.col("size")).otherwise(F.col("size"))
    may = (F.col("size") > 0) & (F.col("whole") < MOST_COPIES)
    return (
        rounded.where(may)
        .join(off, "source_key")
        .withColumn("gain", F.abs("off") - F.abs(F.col("off") + change))
        .where("gain > 0")
        .groupBy("source_key")
        .agg(F.max(F.struct("gain", "seed", "row")).alias("best"))
        .select(F.col("best.row").alias("row"), F.lit(True).alias("switch"))
    )


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies, taken) for every row of the documents.

    ``row`` identifies the rows (see ``numbered``).
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sizes = written(
        numbered(documents.select("doc_id", "source", "text")).select(
            "row", "doc_id", "source", key.alias("source_key"), n_words(F.col("text")).alias("size")
        ),
        "sizes",
    )
    sources = sizes.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    wanted = written(targets(sources, weights, share), "targets")
    flagged = sizes.join(wanted.select("source_key", F.col("target").alias("__target")), "source_key")
    flagged = flagged.withColumn("large", F.col("size") > LARGE * F.col("__target")).drop("__target")
    flagged = written(flagged, "flagged-sizes")

    # Large documents first: what they leave or take too much is made up for by the others.
    about = wanted.drop("n", "source")
    large = flagged.where("large")
    counts = large.groupBy("source_key").agg(F.count("*").alias("n"))
    first = _rounded(large, written(about.join(counts, "source_key"), "large-targets"))
    taken = first.groupBy("source_key").agg(
        F.sum(F.col("size") * (F.col("whole") + F.col("bump"))).alias("__taken"), F.sum("size").alias("__size")
    )
    rest_size = F.col("source_size") - F.coalesce("__size", F.lit(0))
    rest_target = F.greatest(F.col("target") - F.coalesce("__taken", F.lit(0)), F.lit(0.0))
    rest = wanted.drop("source").join(taken, "source_key", "left").select(
        "source_key",
        "n",
        rest_size.alias("source_size"),
        F.least(rest_target, (MOST_COPIES * rest_size).cast("double")).alias("target"),
    )
    second = _rounded(flagged.where("NOT large"), written(rest, "rest-targets"))
    rounded = written(
        first.unionByName(second).drop("source_size", "target").join(about, "source_key"), "mix-together"
    )
    bump = F.when(F.col("switch"), 1 - F.col("bump")).otherwise(F.col("bump"))
    for i in range(SWITCHES):
        rounded = rounded.join(_switches(rounded), "row", "left").withColumn("bump", bump).drop("switch")
        rounded = written(rounded, f"mix-switched-{i}")
    copies = F.col("whole") + F.col("bump")
    return rounded.select(
        "row", "doc_id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken")
    )
