"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation.

The model predicts a token's class from the two classes before it: the context vector is
``R[c1] A1 + R[c2] A2`` and a class scores ``context . Q[class] + b[class]``. The end token
and the most frequent words are classes of their own; other words share classes by their
endings. A word inside a class has its discounted share of the class's counts, and words
never seen share what the discount sets free. Both parts add up to one.

* Counts cover every training text; words beyond the frequent ones are met by a join, so
  the vocabulary may be of any size. Only a bounded number of frequent words is sent out.
* Training runs over every training text: each task does numpy updates over its rows from
  the same start, and Spark averages the parameters, weighted by tokens.
* The normaliser of each context pair comes from batched matrix products once, so a token
  costs table look-ups.

Nulls and odd input: a null text is empty (the end token alone). A null doc_id counts as
the empty text in the fold rule, so it is held out. Repeated rows are counted and scored
each. With no training text every class is equally likely. Other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.columns import numbered
from pricewatch.session import written

END = b""  # no word is empty
OWN_CLASS = 255
ENDINGS = 256
CLASSES = 1 + OWN_CLASS + ENDINGS
BEGIN = CLASSES  # a context only
SIZE = 16
#: At most so many frequent words are sent to the tasks.
FREQUENT = 250_000
DISCOUNT = 0.75
SMOOTH = 0.1
NOISE, BATCH, RATE = 64, 1024, 0.1
AT_ONCE = 200_000
_BINS_PER_OCTAVE = 8


def ending(word: bytes) -> int:
    """The class of a word without one of its own."""
    bare = word.rstrip(b".,;:!?\"')")
    mark = 0 if len(bare) == len(word) else 1 + (word[len(bare)] == 44)
    return 1 + OWN_CLASS + 3 * (zlib.crc32(bare[-3:]) % (ENDINGS // 3)) + mark


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all tokens of the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(counted: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(counted.keys(), pa.binary()), "c": pa.array(counted.values(), pa.int64())}
            )

        counted: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counted.update(tokens(text))
                if len(counted) > 400_000:
                    yield flushed(counted)
                    counted = Counter()
        yield flushed(counted)

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks need of the counts: the frequent words, class totals, and overall totals."""

    frequent: bytes
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    total: int
    distinct: int

    def places(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.frequent.split(b"\n"))} if len(self.counts) else {}

    def classes(self) -> np.ndarray:
        """The class of each frequent word, by place. The first place is the end token."""
        return np.array(
            [i if i <= OWN_CLASS else ending(w) for i, w in enumerate(self.frequent.split(b"\n")[: len(self.counts)])], np.int64
        )

    def log_base(self, c):
        return np.log10((np.asarray(c) + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1)))

    def log_within(self) -> np.ndarray:
        """log10 share of each frequent word inside its class."""
        k = self.classes()
        share = (self.counts - DISCOUNT) / np.maximum(self.class_tokens[k], 1)
        return np.where(np.arange(len(k)) <= OWN_CLASS, 0.0, np.log10(np.maximum(share, 1e-300)))

    def log_unseen(self) -> np.ndarray:
        """log10 share of unseen words, by class."""
        seen = self.class_tokens > 0
        share = DISCOUNT * self.class_words / np.maximum(self.class_tokens, 1)
        return np.where(seen, np.log10(np.maximum(share, 1e-300)), 0.0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From written counts. Frequent words are those above a count that at most FREQUENT words reach."""
    octave = F.floor(F.log2("c") * _BINS_PER_OCTAVE).cast("int")
    bins = counts.groupBy(octave.alias("bin")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    total, distinct = sum(r.c for r in bins), sum(r.n for r in bins)
    least, held = None, 0
    for r in sorted(bins, key=lambda r: -r.bin):
        held += r.n
        if held > FREQUENT:
            break
        least = r.bin
    chosen = counts.where((octave >= (least if least is not None else 1 << 20)) & (F.length("word") > 0)).toArrow()
    words, c = chosen.column("word").to_pylist(), chosen.column("c").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-c[i], words[i]))
    ends = counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0
    listed = [END, *(words[i] for i in order)]
    own = set(listed[1 : OWN_CLASS + 1])

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            k = np.fromiter((0 if w == END or w in own else ending(w) for w in found), np.int64, len(found))
            n = np.bincount(k, batch.column("c").to_numpy(), CLASSES).astype("i8")
            v = np.bincount(k, minlength=CLASSES)
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(CLASSES)), "n": pa.array(n), "v": pa.array(v.astype("i8"))})

    sums = counts.mapInArrow(by_class, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums.collect():  # one row for each class
        class_tokens[r.k], class_words[r.k] = r.n, r.v
    class_tokens[0] = ends
    top = [int(c[i]) for i in order[:OWN_CLASS]]
    class_tokens[1 : len(top) + 1] = top
    all_counts = np.array([ends, *(c[i] for i in order)], np.int64)
    return Vocabulary(b"\n".join(listed), all_counts, class_tokens, class_words, int(total), int(distinct))


class Reader:
    """Texts as places of frequent words (-1 for others) and classes."""

    def __init__(self, v: Vocabulary):
        self.places, self.class_of = v.places(), v.classes()

    def __call__(self, texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
        listed = [tokens(t) for t in texts]
        n = sum(map(len, listed))
        get = self.places.get
        at = np.fromiter((get(w, -1) for w in chain.from_iterable(listed)), np.int64, n)
        k = self.class_of[at] if len(self.class_of) else np.zeros(n, np.int64)
        rare = np.flatnonzero(at < 0)
        if len(rare):
            flat = list(chain.from_iterable(listed))
            k[rare] = [ending(flat[i]) for i in rare]
        return listed, at, k


def contexts(k: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before each token of texts laid end to end."""
    starts = np.cumsum(lengths) - lengths
    one = np.concatenate([[BEGIN], k[:-1]])
    two = np.concatenate([[BEGIN, BEGIN], k[:-2]])[: len(k)]
    one[starts] = BEGIN
    two[starts] = BEGIN
    second = starts[lengths > 1] + 1
    two[second] = BEGIN
    return one, two


@dataclass
class Model:
    """Context vectors R, position matrices A1 and A2, class vectors Q and biases b."""

    R: np.ndarray
    A1: np.ndarray
    A2: np.ndarray
    Q: np.ndarray
    b: np.ndarray

    @staticmethod
    def start(class_tokens: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        share = (class_tokens + 1) / (class_tokens.sum() + CLASSES)
        small = lambda *shape: rng.normal(0, 0.3, shape).astype("f4")
        eye = np.eye(SIZE, dtype="f4") / 2
        return Model(small(CLASSES + 1, SIZE), eye, eye.copy(), small(CLASSES, SIZE), np.log(share).astype("f4"))

    def parts(self) -> list[np.ndarray]:
        return [self.R, self.A1, self.A2, self.Q, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, values: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(values[at : at + p.size].reshape(p.shape).astype("f4"))
            at += p.size
        return Model(*out)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (class before, class), by (class two before, class) with the bias, and log Z by both contexts."""
        one = (self.R @ self.A1 @ self.Q.T).astype("f8")
        two = (self.R @ self.A2 @ self.Q.T).astype("f8") + self.b
        log_z = np.empty((CLASSES + 1, CLASSES + 1))
        e_two = np.exp(two - two.max(1, keepdims=True))
        e_one = np.exp(one - one.max(1, keepdims=True))
        log_z = np.log(e_one @ e_two.T) + one.max(1)[:, None] + two.max(1)[None, :]
        return one, two, log_z


def _rows(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of value rows by index."""
    order = np.argsort(index, kind="stable")
    sorted_index = index[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_index[1:] != sorted_index[:-1]]))
    out = np.zeros((n, values.shape[1]), values.dtype)
    out[sorted_index[first]] = np.add.reduceat(values[order], first)
    return out


class Trainer:
    """Noise-contrastive updates; the noise is drawn from the classes' frequencies and shared by a batch."""

    def __init__(self, model: Model, class_tokens: np.ndarray, seed: int):
        self.m = Model(*(p.copy() for p in model.parts()))
        self.sums = [np.full(p.shape, 1e-6, "f4") for p in self.m.parts()]
        self.rng = np.random.default_rng(seed)
        share = (class_tokens + 1) / (class_tokens.sum() + CLASSES)
        self.upto, self.log_kq = np.cumsum(share), np.log(NOISE * share).astype("f4")

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        m, n = self.m, len(target)
        noise = np.minimum(np.searchsorted(self.upto, self.rng.random(NOISE)), CLASSES - 1)
        r1, r2, q, qn = m.R[one], m.R[two], m.Q[target], m.Q[noise]
        context = r1 @ m.A1 + r2 @ m.A2
        true = np.einsum("ij,ij->i", context, q) + m.b[target] - self.log_kq[target]
        false = context @ qn.T + (m.b[noise] - self.log_kq[noise])
        g_true = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        g_false = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        g_context = g_true[:, None] * q + g_false @ qn
        g_q = _rows(target, g_true[:, None] * context, CLASSES) + _rows(noise, g_false.T @ context, CLASSES)
        g_b = np.bincount(target, g_true, CLASSES) + np.bincount(noise, g_false.sum(0), CLASSES)
        g_r = _rows(one, g_context @ m.A1.T, CLASSES + 1) + _rows(two, g_context @ m.A2.T, CLASSES + 1)
        grads = [g_r, r1.T @ g_context, r2.T @ g_context, g_q, g_b.astype("f4")]
        for p, s, g in zip(m.parts(), self.sums, grads, strict=True):
            g = g / n
            s += g * g
            p += RATE * g / np.sqrt(s)


def train(texts: DataFrame, v: Vocabulary) -> Model:
    """One pass over all training texts in every task, then the token-weighted mean of the parameters."""
    first = Model.start(v.class_tokens)
    shared = texts.sparkSession.sparkContext.broadcast(cloudpickle.dumps((v, first)))  # FREQUENT bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = pickle.loads(shared.value)
        reader, trainer, seen = Reader(vocab), Trainer(model, vocab.class_tokens, 11), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in _portions(texts):
                listed, _, k = reader(part)
                one, two = contexts(k, np.array([len(x) for x in listed]))
                order = trainer.rng.permutation(len(k))
                for at in range(0, len(k), BATCH):
                    own = order[at : at + BATCH]
                    trainer.step(one[own], two[own], k[own])
                seen += len(k)
        if seen:
            flat = trainer.m.flat().astype("f8")
            yield pa.RecordBatch.from_pydict(
                {"at": pa.array(np.arange(len(flat), dtype="i4")), "sum": pa.array(flat * seen), "n": pa.array(np.full(len(flat), seen, "i8"))}
            )

    mean = texts.mapInArrow(run, "at int, sum double, n long").groupBy("at").agg((F.sum("sum") / F.sum("n")).alias("mean"))
    table = mean.toArrow()  # one row for each parameter
    values = first.flat().astype("f8")
    values[table.column("at").to_numpy()] = table.column("mean").to_numpy()
    return first.filled(values)


def _portions(texts: list) -> Iterator[list]:
    """Runs of texts of bounded total length."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "") // 6 + 1
        if size >= AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _scored(rows: DataFrame, v: Vocabulary, model: Model) -> DataFrame:
    """Sums over end token and frequent words, all class scores, and the other words with their classes."""
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps((v, model.tables())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, (one_scores, two_scores, log_z) = pickle.loads(shared.value)
        reader = Reader(vocab)
        base_of, within = vocab.log_base(vocab.counts), vocab.log_within()
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "base", "score", "rare")}
            for part in _portions(batch.column("text").to_pylist()):
                listed, at, k = reader(part)
                lengths = np.array([len(x) for x in listed])
                starts = np.cumsum(lengths) - lengths
                one, two = contexts(k, lengths)
                score = (one_scores[one, k] + two_scores[two, k] - log_z[one, two]) / math.log(10)
                known = at >= 0
                place = np.where(known, at, 0)
                base = np.where(known, base_of[place], 0.0)
                score += np.where(known, within[place], 0.0)
                known &= vocab.counts[place] > 0
                columns["n_tokens"] += lengths.tolist()
                columns["n_known"] += np.add.reduceat(known.astype("i8"), starts).tolist()
                columns["base"] += np.add.reduceat(base, starts).tolist()
                columns["score"] += np.add.reduceat(score, starts).tolist()
                for words, start, n in zip(listed, starts, lengths, strict=True):
                    others = np.flatnonzero(at[start : start + n] < 0)
                    counted = Counter(words[i] for i in others)
                    columns["rare"].append([{"word": w, "n": c, "k": ending(w)} for w, c in counted.items()])
            kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "score": pa.float64()}
            kinds["rare"] = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64()), ("k", pa.int32())]))
            yield pa.RecordBatch.from_pydict(
                {"row": batch.column("row"), "doc_id": batch.column("doc_id")}
                | {c: pa.array(x, kinds[c]) for c, x in columns.items()}
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"row struct<file:bigint,at:bigint>, doc_id {kind}, n_tokens long, n_known long, base double, score double, "
        "rare array<struct<word:binary,n:bigint,k:int>>",
    )


def score(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from the documents that are not held out.
    """
    learning = documents.where(~held_out(F.col("doc_id"))).select("text")
    counts = written(word_counts(learning), "word-counts")
    v = vocabulary(counts)
    model = train(learning, v)
    scored = written(_scored(numbered(documents.select("doc_id", "text")), v, model), "scored")

    bottom = v.total + SMOOTH * (v.distinct + 1)
    rare = scored.select("row", F.inline("rare")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))

    def by_class(values: np.ndarray) -> Column:
        return F.get(F.lit([float(x) for x in values]), F.col("k"))

    unseen, totals = by_class(v.log_unseen()), by_class(np.maximum(v.class_tokens, 1))
    seen = F.log10(F.greatest(c - DISCOUNT, F.lit(1e-300)) / totals)
    others = rare.select(
        "row",
        F.lit(None).cast(scored.schema["doc_id"].dataType).alias("doc_id"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.log10((c + SMOOTH) / bottom)).alias("base"),
        (F.col("n") * F.when(c > 0, seen).otherwise(unseen)).alias("score"),
    )
    return (
        scored.drop("rare")
        .unionByName(others)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .select(
            "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
            F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score",
        )
    )
