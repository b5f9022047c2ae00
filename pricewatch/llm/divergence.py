"""Source divergence audit: how far the terms of a language's sources differ.

One ``CountVectorizer`` counts the terms of all languages: a term carries its language, and
a document has one, so ``minDF`` is the least number of documents of that language. The
vocabulary has no size limit (``vocabSize`` is the largest integer); it lies on the driver
and on every executor, as in any use of a count vectorizer, and grows with the number of
distinct terms of ten documents, not with the rows. It is fitted on each document's different
terms, which decide ``minDF`` as all of them do. It then turns the texts of a group that a task
meets together into sparse vectors, one for each binary digit of the terms' numbers there, so a
repeated term is looked up once a digit. The vectors are summed by group and index, weighed by
their digit, in the tasks, then by a shuffle; no dense sum is held.

Pairs are evaluated by blocks of terms. In a block the cells of a source that are not zero
are gathered against all sources of the language, which gives the sums over the terms of
either; a term of both is added by one of them, and terms of neither count by the value that
two zero counts have. A block returns numbers for pairs of sources, never one a term.

All arithmetic is on integers: products beyond 64 bits are decimals of 38 digits.

Nulls and odd input: a null text, lang or source is the empty string. A text without terms
still makes its group occur. Repeated rows count each. Ties of a rank are broken by the
bytes of the item. A language without kept terms gives pairs of value zero. Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.session import new_table_path, written

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: ASCII letters, in lower case, and all bytes beyond ASCII make terms; any other byte parts them.
_BYTES = bytes(b if chr(b).islower() or b > 127 else b + 32 if chr(b).isupper() else 32 for b in range(256))
#: Bytes of text that are split together, for a fit and for a count of groups, and cells of vectors that are summed together.
_BYTES_TOGETHER, _BYTES_GROUPED, TOGETHER = 1 << 20, 1 << 22, 1 << 19
#: Cells of the matrix of sources and terms that one task holds, with no fewer than LEAST_TERMS terms.
CELLS, LEAST_TERMS = 1 << 14, 64
#: Sources that one task compares with all others of the language.
SLICE = 1024


def _split(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of terms of each text, and all terms in order."""
    offsets = np.frombuffer(text.buffers()[1], "i4")[text.offset : text.offset + len(text) + 1].astype("i8")
    if offsets[0] == offsets[-1]:
        return np.zeros(len(text), np.int64), pa.array([], pa.string())
    edges = offsets - offsets[0]
    data = text.buffers()[2][offsets[0] : offsets[-1]].to_pybytes().translate(_BYTES)
    data = np.frombuffer(data, "u1")
    solid = data != 32
    opens = np.zeros(len(data) + 1, bool)
    opens[edges] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | opens[1:-1]
    starts = np.flatnonzero(begins)
    lengths = np.add.reduceat(solid, starts, dtype="i4") if len(starts) else np.empty(0, "i4")
    ends = np.concatenate([np.zeros(1, "i4"), np.cumsum(lengths, dtype="i4")])
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[solid].tobytes()))
    return np.diff(np.searchsorted(starts, edges)), found


def _slices(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """Slices of (lang, source, text) of so many bytes of text, with the number of terms of each text and all terms in order."""
    for batch in batches:
        at = 0
        while at < len(batch):
            size = pc.binary_length(batch.column(2).slice(at)).to_numpy()
            rows = max(1, int(np.searchsorted(np.cumsum(size, dtype="i8"), together)))
            part = batch.slice(at, rows)
            at += rows
            yield part, *_split(part.column(2))


def _lists(sizes: np.ndarray, terms: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4")), terms)


def _different_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(terms) from (lang, source, text): each term of a text once, with its language in front."""
    for part, counts, found in _slices(batches, _BYTES_TOGETHER):
        if len(found):
            coded = found.dictionary_encode()
            row = np.repeat(np.arange(len(part)), counts)
            row, code = np.divmod(np.unique(row * len(coded.dictionary) + coded.indices.to_numpy()), len(coded.dictionary))
            terms = pc.binary_join_element_wise(part.column(0).take(pa.array(row)), coded.dictionary.take(pa.array(code)), " ")
            yield pa.RecordBatch.from_arrays([_lists(np.bincount(row, minlength=len(part)), terms)], ["terms"])


def _digits_of_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, digit, terms) from (lang, source, text): the terms whose number in the group's texts of a slice has that binary digit."""
    for part, counts, found in _slices(batches, _BYTES_GROUPED):
        if not len(found):
            continue
        lang, source, coded = (c.dictionary_encode() for c in (part.column(0), part.column(1), found))
        group = lang.indices.to_numpy().astype("i8") * len(source.dictionary) + source.indices.to_numpy()
        groups, group = np.unique(group, return_inverse=True)
        cell, n = np.unique(np.repeat(group, counts) * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True)
        row, code = np.divmod(cell, len(coded.dictionary))
        of_lang, of_source = np.divmod(groups, len(source.dictionary))
        for digit in range(int(n.max()).bit_length()):
            there = np.flatnonzero(n >> digit & 1)
            if not len(there):
                continue
            sizes = np.bincount(row[there], minlength=len(groups))
            used = np.flatnonzero(sizes)
            tags = lang.dictionary.take(pa.array(of_lang[row[there]]))
            terms = pc.binary_join_element_wise(tags, coded.dictionary.take(pa.array(code[there])), " ")
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(of_lang[used])),
                    source.dictionary.take(pa.array(of_source[used])),
                    pa.array(np.full(len(used), digit, "i4")),
                    _lists(sizes[used], terms),
                ],
                ["lang", "source", "digit", "terms"],
            )


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, idx, n) from (key, indices, values, digit): sums of sparse vectors that a task meets together, weighed by their digits."""
    for batch in batches:
        at = 0
        while at < len(batch):
            size = np.diff(batch.column(1).slice(at).offsets.to_numpy())
            rows = max(1, int(np.searchsorted(np.cumsum(size), TOGETHER)))
            part, size = batch.slice(at, rows), size[:rows]
            at += rows
            keys, group = np.unique(part.column(0).to_numpy(), return_inverse=True)
            cell = np.repeat(group.astype("i8") << 32, size) | part.column(1).flatten().to_numpy()
            order = np.argsort(cell)
            n = part.column(2).flatten().to_numpy().astype("i8") << np.repeat(part.column(3).to_numpy().astype("i8"), size)
            n, cell = n[order], cell[order]
            start = np.flatnonzero(np.diff(cell, prepend=-1))
            total = np.add.reduceat(n, start) if len(start) else n[:0]
            columns = [keys[cell[start] >> 32], (cell[start] & 0xFFFFFFFF).astype("i4"), total.astype("i8")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "idx", "n"])


def _share(count: str, total: str, size: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * size)) of three columns, exactly."""
    part = f"CAST({count} + 2 AS DECIMAL(19, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return F.expr(f"1 + ({part}) div CAST({total} + 2 * {size} AS DECIMAL(20, 0))")


def _apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two columns of shares."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def keyed_groups(documents: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, key) of all groups, and the salt with which their 64-bit keys are all different."""
    groups = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = written(groups, "groups")
    salt = 0
    while True:
        keyed = groups.withColumn("key", F.xxhash64(F.lit(salt), "lang", "source"))
        if keyed.groupBy("key").count().where("count > 1").isEmpty():
            return keyed, salt
        salt += 1


def counted(documents: DataFrame, salt: int) -> tuple[DataFrame, DataFrame]:
    """(key, idx, n) of the kept terms that occur in a group, and (idx, lang, term) of all kept terms."""
    spark = documents.sparkSession
    texts = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # A term has no space, so its language is all before the last one.
    once = texts.mapInArrow(_different_terms, "terms array<string>")
    tagged = texts.mapInArrow(_digits_of_terms, "lang string, source string, digit int, terms array<string>")
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=MIN_DOCUMENTS, vocabSize=2**31 - 1).fit(once)
    saved = new_table_path(spark, "vectorizer")  # so the vocabulary becomes a table without Python
    model.write().save(saved)
    vocabulary = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("idx", "tagged"))
    kept = vocabulary.select(
        "idx", F.regexp_extract("tagged", r"(?s)^(.*) [^ ]*$", 1).alias("lang"), F.substring_index("tagged", " ", -1).alias("term")
    )
    key = F.xxhash64(F.lit(salt), "lang", "source").alias("key")
    vectors = model.transform(tagged).select(key, "digit", F.unwrap_udt("vector").alias("v"))
    cells = vectors.select("key", "v.indices", "v.values", "digit").mapInArrow(_group_sums, "key long, idx int, n long")
    sums = cells.groupBy("key", "idx").agg(F.sum("n").alias("n"))
    return written(sums, "term-counts"), written(kept, "vocabulary")


def _block_pairs(key: tuple, cells: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sums over the block's terms of either source for pairs (a < b), as far as a source of this slice adds them.

    A source adds the terms it has; those of both are left to the smaller one.
    """
    lang, _, part = key
    names = np.array(sorted(sources["source"], key=str.encode), object)
    place = {s: i for i, s in enumerate(names)}
    zero = np.zeros(len(names), np.int64)
    zero[sources["source"].map(place)] = sources["p0"]
    at = cells["source"].map(place).to_numpy()
    terms, column = np.unique(cells["idx"].to_numpy(), return_inverse=True)
    p = np.repeat(zero[:, None], len(terms), 1)
    p[at, column] = cells["p"]
    there = np.zeros(p.shape, bool)
    there[at, column] = True
    out = []
    for i in np.unique(at):
        if i % sources["slices"].iloc[0] != part:
            continue
        own = np.flatnonzero(there[i])
        mine, others = p[i, own], p[:, own]
        counts = ~there[:, own]
        counts[i + 1 :] = True
        value = ((mine - others) ** 2 // (mine + others) * counts).sum(1)
        j = np.flatnonzero(counts.any(1) & (np.arange(len(names)) != i))
        n = counts[j].sum(1)
        out.append(pd.DataFrame({"a": names[np.minimum(i, j)], "b": names[np.maximum(i, j)], "sum": value[j], "terms": n}))
    found = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "sum": [], "terms": []})
    return found.assign(lang=lang)[["lang", "a", "b", "sum", "terms"]]


def audit(documents: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of the sources of a language, and their most typical terms."""
    groups, salt = keyed_groups(documents)
    sums, vocabulary = counted(documents, salt)
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("size"))
    totals = sums.groupBy("key").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, "key", "left").join(sizes, "lang", "left").fillna(0, ["total", "size"])
    none = F.when(F.col("size") > 0, _share("0", "total", "size")).otherwise(1)
    groups = written(groups.withColumn("p0", none.cast("long")), "groups")
    counts = sums.join(groups, "key").select("lang", "source", "idx", "n", _share("n", "total", "size").alias("p"))
    counts = written(counts, "term-shares")
    shares = counts.select("lang", "source", "idx", "p")

    # Pairs, by blocks of terms.
    widest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = max(LEAST_TERMS, CELLS // widest)
    slices = groups.groupBy("lang").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    blocked = shares.withColumn("block", F.floor(F.col("idx") / width)).join(slices, "lang")
    blocked = blocked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    present = written(blocked.select("lang", "block", "slice", "slices").distinct(), "term-blocks")
    sides = groups.select("lang", "source", "p0").join(present, "lang")
    task = ["lang", "block", "slice"]
    sums = (
        blocked.groupBy(*task)
        .cogroup(sides.groupBy(*task))
        .applyInPandas(_block_pairs, "lang string, a string, b string, sum long, terms long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("sum").alias("sum"), F.sum("terms").alias("terms"))
    )
    one = groups.select("lang", "size", F.col("source").alias("a"), F.col("p0").alias("p"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("q"))
    pairs = one.join(two, "lang").where("a < b").join(sums, ["lang", "a", "b"], "left").fillna(0, ["sum", "terms"])
    value = F.when(F.col("size") > 0, F.col("sum") + (F.col("size") - F.col("terms")) * _apart("p", "q")).otherwise(0)
    pairs = pairs.withColumn("value", value)
    directed = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", "b", "a", "value")
    )

    # Terms, against the whole language.
    of_lang = counts.groupBy("lang").agg(F.sum("n").alias("total")).join(sizes, "lang")
    whole = counts.groupBy("lang", "idx").agg(F.sum("n").alias("n")).join(of_lang, "lang")
    whole = whole.select("idx", _share("n", "total", "size").alias("q")).join(vocabulary.select("idx", F.col("term").alias("item")), "idx")
    typical = shares.join(whole, "idx").where("p > q").select("lang", "source", "item", _apart("p", "q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked = F.row_number().over(order).alias("rank")
    pairs = directed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    typical = typical.select("lang", "source", F.lit("term").alias("part"), "item", "value", ranked).where(F.col("rank") <= TOP_TERMS)
    return pairs.select(*columns).union(typical.select(*columns))
