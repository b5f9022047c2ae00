"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function). Every function takes (spark, docs, sf_dir) and returns a
table that is written and read again as the next one's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.functions.once import computed_once
from pricewatch.llm import mixing, near_copies, packing, quality, secret_scans
from pricewatch.llm.columns import numbered, read
from pricewatch.llm.queries import TOKENIZER
from pricewatch.session import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    docs = docs.select(*COLUMNS)
    rows = written(quality.measured(docs, "doc_id"), "measures")
    rules = quality.learn(rows, read(spark, sf_dir, "labels"))
    return quality.measured(docs, *COLUMNS).where(quality.verdict(rules)).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the SimHash trie join and bands beyond its bits, five-word shingles, Jaccard 0.8 or more."""
    return near_copies.deduplicated(docs.select(*COLUMNS))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of a secret replaced by a mark."""
    clean = computed_once(
        docs.select(*COLUMNS), {"text": secret_scans.redacted(F.col("text"), secret_scans.spans(F.col("text")))}
    )
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = numbered(docs.select(*COLUMNS))
    copies = mixing.mix(rows.drop("row")).where("copies > 0").select("row", "copies")
    return (
        rows.join(copies.hint("shuffle_hash"), "row")  # the texts move once, at every size
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*COLUMNS)
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", one_of_each),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# Components, seeded rounding and tokens are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
