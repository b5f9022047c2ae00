"""Pattern packing: documents into training sequences by non-negative least squares.

Token counts become a histogram with one bin for each length up to the sequence length,
whatever the number of documents. Patterns are sets of two or three lengths that fill a
sequence exactly. Repeat counts of the patterns are fitted to the histogram by
non-negative least squares (multiplicative updates), rounded and cut to what the bins
hold. What is left over is packed by best fit, largest length first, also on the
histogram: a pattern found once is repeated as often as its bins allow. The plan therefore
depends on the sequence length only. Then every piece gets its rank among the pieces of
its length, from counts over (length, salt) so that a frequent length is spread over many
tasks, and its rank names its place in the plan.

Only documents longer than a sequence are cut; their full pieces are sequences.

Nulls and odd input: a null or empty text is the end token alone. Repeated rows are packed
each. A null doc_id stays null. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.columns import numbered
from pricewatch.session import written

LENGTH = 2048
END = 0
#: Of the exact triples every eighth is a pattern; together with all pairs about 45,000.
TRIPLE_STEP = 8
PIECES_PER_SALT = 2000
SALTS = (64, 4096)


# Below this code point no character joins with its neighbours and lower case goes
# character by character, so parts of words can be told without the tokenizer.
_PLAIN = "\u0130"
_LETTERS, _NUMBERS = (
    "".join(re.escape(chr(i)) for i in range(ord(_PLAIN)) if unicodedata.category(chr(i))[0] == kind) for kind in "LN"
)
_SEPARATORS, _SPACE = re.compile("[\x1c-\x1f]"), re.compile(r"[^\S\x1c-\x1f]+")
_PARTS = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")


def _gathered(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the coded entries end to end, and each entry's number of ids."""
    n = lengths[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total) + np.repeat(starts[codes] - (ends - n), n)], n


class _Table:
    """Strings with their ids, found by their place."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def add(self, strings: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.place.update(zip(strings, range(len(self.lengths), len(self.lengths) + len(strings)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def codes(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the strings of all lists, and the lengths of the lists."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(map(self.place.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum())), counts

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _gathered(codes, self.starts, self.lengths, self.ids)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


class WordTokenizer:
    """Token ids by a tokenizers file, with the ids of words and of their parts remembered.

    White space never joins tokens of this vocabulary, so a text's ids are its words' ids.
    Nor does it join letters, digits and other characters, whose case it ignores: a new
    word is mostly a known run of letters beside a mark. New parts are encoded together;
    each ends with an end-of-word token. Words with an apostrophe, with "<" (of special
    tokens) or with characters beyond ``_PLAIN`` are encoded whole.
    """

    REMEMBERED = 400_000
    AT_ONCE = 200_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words, self.parts = _Table(), _Table()

    def _encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _learn_parts(self, plain: list[str], others: list[str]) -> None:
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids, _ = self._encode([" ".join(some)])
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                self.parts.add(some, ids, np.diff(ends, prepend=0))
            else:
                self.parts.add(some, *self._encode(some))
        if others:
            self.parts.add(others, *self._encode(others))

    def _learn(self, words: list[str]) -> None:
        if len(self.parts.place) > self.REMEMBERED:
            self.parts = _Table()
        known = self.parts.place
        split, whole = [], []
        for w in words:
            if (w.isascii() or max(w) < _PLAIN) and "'" not in w and "<" not in w:
                split.append(_PARTS.findall(w.lower()))
            else:
                split.append([w])
                whole.append(w)
        others = set(whole)
        new = [p for p in set(chain.from_iterable(split)) if p not in known]
        self._learn_parts([p for p in new if p not in others], [p for p in new if p in others])
        codes, counts = self.parts.codes(split)
        ids, lengths = self.parts.gather(codes)
        self.words.add(words, ids, _sums(lengths, counts))

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        batch, size = [], 0
        for text in texts:
            # Python counts four separators as white space that the vocabulary does not.
            words = text.split() if not _SEPARATORS.search(text) else [w for w in _SPACE.split(text) if w]
            batch.append(words)
            size += len(words)
            if size >= self.AT_ONCE:
                yield from self._encoded(batch)
                batch, size = [], 0
        yield from self._encoded(batch)

    def _encoded(self, batch: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.words.place) > self.REMEMBERED:
            self.words = _Table()
        self._learn([w for w in set(chain.from_iterable(batch)) if w not in self.words.place])
        codes, counts = self.words.codes(batch)
        ids, lengths = self.words.gather(codes)
        start = 0
        for stop in np.cumsum(_sums(lengths, counts)):
            yield ids[start:stop]
            start = stop


def _of_this_worker(path: str) -> WordTokenizer:
    """The tokenizer of the Python worker, which serves many tasks; it remembers words across them."""
    kept = sys.modules.setdefault("_pricewatch_worker", types.ModuleType("_pricewatch_worker")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


def pieces(documents: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every document, and ``ids`` if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _of_this_worker(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out: list[tuple] = []
            kept: list[np.ndarray] = []
            for i, ids in enumerate(encode(texts)):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    out.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
                    if with_ids:
                        kept.append(part)
            table = np.array(out, np.int64).reshape(-1, 5)
            of = pa.array(table[:, 0])
            columns = {"row": batch.column("row").take(of), "doc_id": batch.column("doc_id").take(of)}
            columns["piece"] = pa.array(table[:, 1].astype("i4"))
            columns |= {name: pa.array(table[:, k]) for k, name in ((2, "start"), (3, "length"), (4, "ids_crc32"))}
            if with_ids:
                columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    rows = numbered(documents.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row struct<file:bigint,at:bigint>, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def patterns(length: int) -> np.ndarray:
    """Rows of three lengths (0 for none) that fill a sequence exactly."""
    a = np.arange(-(-length // 2), length)
    pairs = np.stack([a, length - a, np.zeros_like(a)], 1)
    a, b = np.meshgrid(np.arange(1, length), np.arange(1, length), indexing="ij")
    c = length - a - b
    fits = (a >= b) & (b >= c) & (c >= 1) & ((31 * a + 17 * b) % TRIPLE_STEP == 0)
    return np.concatenate([pairs, np.stack([a[fits], b[fits], c[fits]], 1)])


def fitted(histogram: np.ndarray, sets: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Repeats x >= 0 of the patterns that come closest to the histogram in squares."""
    size = len(histogram)
    h = histogram.astype(float)
    h[0] = 0
    used = (sets > 0).astype(float)
    usable = np.all((sets == 0) | (h[sets] > 0), axis=1)
    x = np.where(usable, 1.0, 0.0)
    pull = (h[sets] * used).sum(1)
    for _ in range(rounds):
        made = np.bincount(sets.ravel(), (x[:, None] * used).ravel(), size)
        push = (made[sets] * used).sum(1)
        x *= np.where(usable, pull / np.maximum(push, 1e-12), 0.0)
    return x


def plan(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): patterns that use every entry of the histogram once.

    Of the fit with pairs and triples, the fit with pairs, and no fit at all (every entry is
    a residual), the plan with the fewest sequences is taken, in this order if equal.
    """
    sets = patterns(length)
    plans = [_planned(histogram, length, chosen) for chosen in (sets, sets[sets[:, 2] == 0], sets[:0])]
    return min(plans, key=lambda p: sum(repeats for _, repeats in p))


def _planned(histogram: np.ndarray, length: int, sets: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    left = histogram.astype(np.int64).copy()
    done: list[tuple[tuple[int, ...], int]] = []
    if left[length]:
        done.append(((length,), int(left[length])))
        left[length] = 0
    x = fitted(left, sets) if left.any() else np.zeros(len(sets))
    for k in np.argsort(-x, kind="stable"):
        repeats = int(x[k] + 0.5)
        if repeats < 1:
            break
        lengths = tuple(int(v) for v in sets[k] if v)
        repeats = min(repeats, *(int(left[v]) // lengths.count(v) for v in lengths))
        if repeats > 0:
            done.append((lengths, repeats))
            for v in lengths:
                left[v] -= repeats
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return done
        spare, room, chosen = left.copy(), length, []
        while room:
            fits = int(np.searchsorted(present, room, "right")) - 1
            while fits >= 0 and not spare[present[fits]]:
                fits -= 1
            if fits < 0:
                break
            chosen.append(int(present[fits]))
            spare[chosen[-1]] -= 1
            room -= chosen[-1]
        repeats = min(int(left[v]) // chosen.count(v) for v in set(chosen))
        done.append((tuple(chosen), repeats))
        for v in chosen:
            left[v] -= repeats


def packed(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces."""
    bins = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    histogram = np.zeros(length + 1, np.int64)
    for size, n in bins.items():
        histogram[size] = n
    salts = int(min(max(sum(bins.values()) // PIECES_PER_SALT, SALTS[0]), SALTS[1]))

    # Slots of the plan by length: from which rank on, the first sequence, the offset in it.
    slots: list[tuple[int, int, int, int]] = []
    taken = np.zeros(length + 1, np.int64)
    sequence = 0
    for lengths, repeats in plan(histogram, length):
        offset = 0
        for size in lengths:
            slots.append((size, int(taken[size]), sequence, offset))
            taken[size] += repeats
            offset += size
        sequence += repeats
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    first = np.searchsorted(table[:, 0], np.arange(length + 2))
    shared = cut.sparkSession.sparkContext.broadcast((table, first))  # a few slots for each pattern

    @F.pandas_udf("sequence_id long, offset long")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        slots, first = shared.value
        size, rank = sizes.to_numpy(), ranks.to_numpy()
        at = np.empty(len(size), np.int64)
        for s in np.unique(size):
            own = size == s
            at[own] = first[s] + np.searchsorted(slots[first[s] : first[s + 1], 1], rank[own], "right") - 1
        return pd.DataFrame({"sequence_id": slots[at, 2] + rank - slots[at, 1], "offset": slots[at, 3]})

    salted = cut.withColumn("__salt", F.pmod(F.xxhash64("row", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__salt").orderBy("row", "piece")
    ranked = (
        salted.withColumn("__in", F.row_number().over(within) - 1)
        .join(starts, ["length", "__salt"])
        .withColumn("__rank", F.col("__in") + F.col("__before"))
    )
    return ranked.withColumn("__place", place("length", "__rank")).select(
        *cut.columns, "__place.sequence_id", "__place.offset"
    )


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece, and ``ids`` if asked for."""
    return packed(written(pieces(documents, tokenizer, length, with_ids), "pieces"), length).drop("row")
