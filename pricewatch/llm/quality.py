"""Quality rules: a decision list learned from labelled rows by sequential covering.

The list is ordered: the first rule whose threshold conditions all hold rejects the
document, and a document that no rule matches is kept. Rules grow one condition at a time
on two thirds of the labelled rows and are pruned on the other third. Every step is one
grouped count over binned features; only those counts reach the driver, so the labelled
set may have any size. All of it is built-in column functions.

Nulls and odd input: a null or empty text has no words and fails the base rule. Labels of
null documents, null labels and documents with contradicting labels teach nothing. With no
usable label the list is empty and only the base rule rejects. Repeated rows each get
their own verdict, and other columns of the documents are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.columns import SPACE, let, words
from pricewatch.session import written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"
WORD_IN = r"[^\x20\x09-\x0D]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What rules may test: ratios and sizes made from the measures.
FEATURES = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "n_dup_lines": "n_dup_lines",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}


def _repeated_words(w: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text."""
    n = F.size(w)

    def at(values: Column, i: Column) -> Column:
        return F.get(values, i)

    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(at(w, i + k) for k in range(WINDOW))))

    def exact(_) -> Column:
        grams = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.struct(F.concat_ws(" ", F.slice(w, i + 1, WINDOW)).alias("gram"), i.alias("at")),
            )
        )

        def repeats(g: Column) -> Column:
            starts = F.transform(
                g,
                lambda x, k: F.when(
                    (x["gram"] == at(g, k - 1)["gram"]) | (x["gram"] == at(g, k + 1)["gram"]), x["at"]
                ),
            )
            found = F.sort_array(F.filter(starts, lambda x: x.isNotNull()))
            return let(
                found,
                lambda s: F.aggregate(
                    F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(at(s, k + 1) - x, F.lit(WINDOW)))),
                    F.lit(0),
                    lambda total, x: total + x,
                ),
            )

        return let(grams, repeats)

    # Equal windows have equal hashes, so texts without equal hashes need no exact look.
    return F.when(n < WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(h)))
    )


def measures(text: Column) -> Column:
    """The five counts of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_IN))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            (F.char_length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed() -> Column:
    """Over the measure columns."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measured(documents: DataFrame, *keep: str) -> DataFrame:
    """The named columns of the documents and the measures of their texts."""
    # Generated, so that a later filter does not measure a second time.
    return documents.select(*keep, F.inline(F.array(measures(F.col("text")))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(f"({FEATURES[self.feature]})")
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _all(conditions: list[Column]) -> Column:
    held = F.lit(True)
    for condition in conditions:
        held = held & condition
    return held


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression over the measure columns: true to keep."""
    listed = F.when(base_failed(), F.lit(False))
    for rule in rules:
        listed = listed.when(_all([c.column() for c in rule]), F.lit(False))
    return listed.otherwise(F.lit(True))


def learn(
    rows: DataFrame,
    labels: DataFrame,
    bins: int = 32,
    max_rules: int = 6,
    max_conditions: int = 3,
    min_precision: float = 0.97,
    min_covered: int = 8,
) -> list[Rule]:
    """Rules from measured rows (``doc_id`` and the measures) and labels (``doc_id``, ``quality``)."""
    sure = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__low"), F.max("quality").alias("__high"))
        .where("__low = __high")
        .select("doc_id", (F.col("__low") == 0).alias("bad"))
    )
    values = (
        rows.where(~base_failed())
        .select("doc_id", *(F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()))
        .join(sure, "doc_id")
    )
    cuts = [i / bins for i in range(1, bins)]
    low = values.agg(*(F.percentile_approx(F.when(F.col("bad"), F.col(f)), cuts, 10_000).alias(f) for f in FEATURES))
    high = values.agg(*(F.percentile_approx(F.when(~F.col("bad"), F.col(f)), cuts, 10_000).alias(f) for f in FEATURES))
    found = (low.first(), high.first())
    thresholds = {f: sorted({t for side in found for t in (side[f] or [])}) for f in FEATURES}
    if not any(thresholds.values()):
        return []

    def bin_of(f: str) -> Column:
        """How many thresholds lie below the value."""
        return F.size(F.filter(F.lit(thresholds[f]), lambda t: t < F.col(f))).cast("int")

    table = written(
        values.select(
            "bad",
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow"),
            *(bin_of(f).alias(f) for f in FEATURES),
        ),
        "quality-bins",
    )

    def holds(test: tuple[str, bool, int]) -> Column:
        f, above, k = test
        return F.col(f) > k if above else F.col(f) <= k

    def grown(rest: Column) -> list[tuple[str, bool, int]]:
        """Conditions added while they raise the precision of what the rule covers."""
        rule: list[tuple[str, bool, int]] = []
        best_so_far = -1.0
        while len(rule) < max_conditions:
            counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
            cells = (
                table.where(rest & F.col("grow") & _all([holds(t) for t in rule]))
                .select("bad", F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in FEATURES))).alias("c"))
                .groupBy("c.f", "c.k")
                .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
            )
            for cell in cells.collect():  # at most one row for each feature and bin
                counts[cell.f][cell.k] = (cell.bad, cell.good)
            choice = None
            for f, by_bin in counts.items():
                bad_all = sum(b for b, _ in by_bin.values())
                good_all = sum(g for _, g in by_bin.values())
                bad = good = 0
                for k in sorted(by_bin)[:-1]:
                    bad, good = bad + by_bin[k][0], good + by_bin[k][1]
                    for above, b, g in ((False, bad, good), (True, bad_all - bad, good_all - good)):
                        if b < min_covered:
                            continue
                        score = (b + 1) / (b + g + 2) + 1e-3 * b / max(bad_all, 1)
                        if choice is None or score > choice[0]:
                            choice = (score, (f, above, k))
            if choice is None or choice[0] <= best_so_far + 1e-4:
                break
            best_so_far = choice[0]
            rule.append(choice[1])
        return rule

    def pruned(rule: list, rest: Column) -> tuple[list, float, int]:
        """The shortest prefix that is as precise on the held rows, its precision and cover."""
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        sums = []
        for i, prefix in enumerate(prefixes):
            hit = _all([holds(t) for t in prefix])
            sums += [F.count_if(hit & F.col("bad")).alias(f"b{i}"), F.count_if(hit).alias(f"n{i}")]
        row = table.where(rest & ~F.col("grow")).agg(*sums).first()
        scored = [((row[f"b{i}"] + 1) / (row[f"n{i}"] + 2), -i) for i in range(len(prefixes))]
        best = -max(scored)[1]
        return prefixes[best], row[f"b{best}"] / max(row[f"n{best}"], 1), row[f"b{best}"]

    rules: list[Rule] = []
    rest = F.lit(True)
    while len(rules) < max_rules:
        rule = grown(rest)
        if not rule:
            break
        rule, precision, covered = pruned(rule, rest)
        if precision < min_precision or covered < max(min_covered // 2, 1):
            break
        rules.append(tuple(Condition(f, above, thresholds[f][k]) for f, above, k in rule))
        rest = rest & ~_all([holds(t) for t in rule])
    return rules

