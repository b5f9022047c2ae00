"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from the trie join of ``simhash`` over the fingerprints of the shingle sets,
and, beyond its bit budget, from MinHash bands: a pair of similarity s shares a bucket with
probability 1 - (1 - s^ROWS)^BANDS, which is 0.99995 at 0.8 and rises from there. Every
candidate is then decided by the exact similarity of both shingle sets, so no chance agreement
links two texts. The trie join alone does not serve: pairs at 0.8 differ in about ten bits and
vary by three, and a budget that finds them leaves nearly all trie nodes open.

Equal shingle sets are one vertex. Candidates are decided in two passes, so that a dense
group of near copies and a crowded bucket of unlike texts both stay cheap: first the links of
the trie join and each member of a bucket with the smallest one; then, in buckets whose members
lie in different components,
the pairs of different components that agree in ``AGREE`` of all ``BANDS * ROWS`` values. A
pair at 0.8 agrees in fewer with a probability below 1 in 100,000. The second pass runs
inside the tasks: signatures, one byte a value, are compared in blocks, what agrees is
decided on the whole sets that the task holds, those most alike first, and a pair that found
links connect already is left. So no pair is a row but a link of the task's forest. A
crowded bucket is cut into parts, and members of its largest component are not compared
with one another.

Nulls and odd input: a text of fewer than five words has one shingle, all its words; null and
empty texts have none and count as copies of each other. Shingles ignore the case of ASCII
letters. Repeated rows are copies. A null doc_id keeps its row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from pricewatch.llm import simhash
from pricewatch.llm.columns import numbered
from pricewatch.llm.components import components
from pricewatch.llm.simhash import majority
from pricewatch.session import written

SHINGLE = 5
#: Least similarity, as a fraction of integers.
LEAST = (4, 5)
BANDS, ROWS = 25, 5
SEED = 42
#: Equal values of two signatures from which a pair is decided exactly.
AGREE = 80
#: Members of a bucket that a part holds, their shingles, and members compared at once.
PART, SHINGLES, _TILE = 1024, 1 << 20, 192
_RANDOM = np.random.default_rng(SEED)
_XOR = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), "u8")
_FACTOR = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), "u8") | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, "u8")
    grams = {b" ".join(g) for g in zip(*(w[i:] for i in range(SHINGLE)), strict=False)} or {b" ".join(w)}
    return np.unique(np.fromiter((xxh64_intdigest(g, SEED) for g in grams), "u8", len(grams)))


def _sketch(text: str | None) -> tuple[int, np.ndarray, bytes, int, int]:
    """A number for the set, one for each band, a byte of each minimum, the size and the fingerprint; no bands for the empty set."""
    from xxhash import xxh64_intdigest

    values = shingles(text)
    number = xxh64_intdigest(values.tobytes(), SEED)
    if not len(values):
        return number, np.empty(0, "u8"), b"", 0, 0
    low = np.full(BANDS * ROWS, np.iinfo("u8").max, "u8")
    for at in range(0, len(values), 2048):
        low = np.minimum(low, ((values[at : at + 2048] ^ _XOR) * _FACTOR).min(1))
    bands = [xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(low.reshape(BANDS, ROWS))]
    return number, np.array(bands, "u8"), (low >> np.uint64(56)).astype("u1").tobytes(), len(values), majority(values)


_SKETCH = (
    StructType()
    .add("key", LongType())
    .add("bands", ArrayType(LongType()))
    .add("signature", BinaryType())
    .add("size", IntegerType())
    .add("fp", LongType())
)


@F.pandas_udf(_SKETCH)
def sketches(texts: pd.Series) -> pd.DataFrame:
    made = [_sketch(t) for t in texts]
    return pd.DataFrame(
        {
            "key": np.array([m[0] for m in made], "u8").view("i8"),
            "bands": [m[1].view("i8") for m in made],
            "signature": [m[2] for m in made],
            "size": np.array([m[3] for m in made], "i4"),
            "fp": np.array([m[4] for m in made], "u8").view("i8"),
        }
    )


@F.pandas_udf(ArrayType(LongType()))
def shingle_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t).view("i8") for t in texts], dtype=object)


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b"
    )
    part, whole = LEAST
    total = F.size("set_a") + F.size("set_b")
    fits = whole * F.least(F.size("set_a"), F.size("set_b")) >= part * F.greatest(F.size("set_a"), F.size("set_b"))
    common = F.when(fits, F.size(F.array_intersect("set_a", "set_b"))).otherwise(0)
    return both.where((whole + part) * common >= part * total).select("a", "b")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    part, whole = LEAST
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return (whole + part) * common >= part * (len(a) + len(b))


def _links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different components in a task's parts, as a forest."""
    _, i, j = key
    rows = rows.sort_values(["root", "key"])
    signature = np.frombuffer(b"".join(rows["signature"]), "u1").reshape(len(rows), -1)
    ids, root, part = (rows[c].to_numpy() for c in ("key", "root", "part"))
    sets = [np.sort(s.view("u8")) for s in rows["set"]]
    size = np.array([len(s) for s in sets])
    bands, band = np.stack(rows["bands"].to_numpy()), int(rows["band"].iloc[0])
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    share, whole = LEAST
    above = {r: r for r in np.unique(root).tolist()}

    def top(r: int) -> int:
        while above[r] != r:
            above[r] = above[above[r]]
            r = above[r]
        return r

    a_out, b_out = [], []
    for p in range(0, len(left), _TILE):
        a = left[p : p + _TILE]
        for q in range(p if i == j else 0, len(right), _TILE):
            b = right[q : q + _TILE]
            if root[a[0]] == root[a[-1]] == root[b[0]] == root[b[-1]]:
                continue
            equal = (signature[a][:, None, :] == signature[b][None, :, :]).sum(2, dtype=np.int16)
            near = (equal >= AGREE) & (root[a][:, None] != root[b][None, :])
            if i == j:
                near &= a[:, None] < b[None, :]
            x, y = np.nonzero(near)
            n = equal[x, y]
            x, y = a[x], b[y]
            fits = whole * np.minimum(size[x], size[y]) >= share * np.maximum(size[x], size[y])
            keep = fits & ((bands[x] == bands[y]).argmax(1) == band)  # of several common buckets the first decides
            order = np.argsort(-n[keep], kind="stable")
            for u, v in zip(x[keep][order].tolist(), y[keep][order].tolist(), strict=True):
                one, two = top(root[u]), top(root[v])
                if one != two and _similar(sets[u], sets[v]):
                    above[max(one, two)] = min(one, two)
                    a_out.append(ids[u])
                    b_out.append(ids[v])
    return pd.DataFrame({"a": np.array(a_out, np.int64), "b": np.array(b_out, np.int64)})


def _open_links(members: DataFrame, distinct: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Links (a, b) in buckets whose members lie in different components of the links."""
    roots = components(links, "a", "b").withColumnRenamed("vertex", "key")
    placed = members.join(roots, "key", "left").select("bucket", "band", "key", "size", F.coalesce("root", "key").alias("root"))
    placed = written(placed, "placed")
    # A member weighs one, a long text as much as it holds.
    weight = F.sum(F.greatest(F.lit(1.0), F.col("size") * PART / SHINGLES))
    by_root = placed.groupBy("bucket", "root").agg(weight.alias("n"))
    top = F.max(F.struct("n", "root"))
    by_bucket = by_root.groupBy("bucket").agg(F.sum("n").alias("n"), top.alias("top"), F.count("*").alias("roots"))
    large = F.col("n") > PART
    parts = by_bucket.where("roots > 1").select(
        "bucket",
        F.col("top.root").alias("main"),
        F.when(large, F.greatest(F.ceil((F.col("n") - F.col("top.n")) / PART), F.lit(1))).otherwise(1).cast("int").alias("open"),
        F.when(large, F.ceil(F.col("top.n") / PART)).otherwise(0).cast("int").alias("closed"),
    )
    open_members = placed.join(written(parts, "open-buckets"), "bucket")
    turn = F.xxhash64("key")
    # Parts below ``open`` hold other components, those from there on the largest one, which is not compared with itself.
    closed = (F.col("root") == F.col("main")) & (F.col("closed") > 0)
    part = F.when(closed, F.col("open") + F.pmod(turn, F.greatest("closed", F.lit(1)))).otherwise(F.pmod(turn, F.col("open")))
    open_members = open_members.withColumn("part", part.cast("int"))
    last = F.when(F.col("part") >= F.col("open"), F.col("open")).otherwise(F.col("open") + F.col("closed")) - 1
    tasks = open_members.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "band", "key", "root", "part"
    )
    tasks = tasks.join(distinct.select("key", "bands", "signature"), "key").join(sets, "key")
    return tasks.groupBy("bucket", "i", "j").applyInPandas(_links, "a long, b long")


def _trie_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets from the trie join of their fingerprints; sets of one fingerprint pair with the smallest."""
    prints = distinct.where("size > 0").select("key", "fp")
    first = written(prints.groupBy("fp").agg(F.min("key").alias("first")), "fingerprints")
    same = prints.join(first, "fp").where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    one, two = (first.select(F.col("fp").alias(fp), F.col("first").alias(key)) for fp, key in (("a", "x"), ("b", "y")))
    apart = simhash.near(first.select("fp")).join(one, "a").join(two, "b")
    return same.union(apart.select(F.least("x", "y"), F.greatest("x", "y")))


def linked(rows: DataFrame, sketched: DataFrame) -> DataFrame:
    """(vertex, root) of the sets that have a near copy; ``rows`` has __row and text, ``sketched`` __row and the fields of a sketch."""
    distinct = sketched.groupBy("key").agg(F.any_value(F.struct("bands", "signature", "size", "fp")).alias("s")).select("key", "s.*")
    distinct = written(distinct, "distinct-sketches")
    members = distinct.select("key", "size", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    members = written(members.join(shared.select("bucket", "first"), "bucket"), "shared-buckets")
    close = written(_trie_pairs(distinct), "trie-pairs")
    wanted = members.select("key").union(close.select("a")).union(close.select("b")).distinct()
    found = sketched.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("__row").alias("__row"))
    found = written(found, "candidates")
    texts = rows.select("__row", "text").join(found.hint("shuffle_hash"), "__row")  # moved once, at every size
    sets = written(texts.select("key", shingle_sets("text").alias("set")), "shingle-sets")
    stars = members.where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    links = written(_alike(stars.union(close).distinct(), sets), "star-links")
    more = written(_open_links(members, distinct, sets, links), "open-links")
    return components(links.union(more), "a", "b")


def deduplicated(documents: DataFrame) -> DataFrame:
    """One document of each component: the smallest doc_id, nulls last, and of equal ones the first row."""
    rows = numbered(documents, "__row")
    made = rows.select("__row", "doc_id", F.explode(F.array(sketches("text"))).alias("sketch"))
    made = written(made.select("__row", "doc_id", "sketch.*"), "sketches")
    roots = written(linked(rows, made), "near-copies")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("__row"))
    smallest = made.groupBy("key").agg(F.min(first).alias("first"))
    smallest = smallest.join(roots.withColumnRenamed("vertex", "key"), "key", "left")
    kept = smallest.groupBy(F.coalesce("root", "key")).agg(F.min("first").alias("first"))
    kept = written(kept.select(F.col("first.__row").alias("__row")), "kept-rows")
    return rows.join(kept.hint("shuffle_hash"), "__row", "left_semi").drop("__row")
