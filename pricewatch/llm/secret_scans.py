"""Secret scans: pattern rules plus sliding-window entropy, with spans in code points.

Base rules are leftmost non-overlapping matches of each kind. The method adds spans of
kind ``entropy``: candidate strings outside the base spans in which some window of
``WINDOW`` characters has a high Shannon entropy for the candidate's character class. The
entropy moves along by counts: the entering and the leaving character each change one
count. The allow list drops candidates that are plain words, paths, numbers or UUIDs as a
whole; its marks of examples only part a candidate, so windows that hold one do not count
and those beside it do. All of it is built-in column functions, so a scan is one pass
without a shuffle.

Nulls and odd input: a null text is empty; an empty text has no spans and the digest of
the empty string. Repeated rows are scanned each; other columns are ignored. A candidate
that touches a base span is judged by its parts outside; a text may hold any number of
candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.columns import let

# Kinds in the order in which spans of equal start are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
MIN_VALUE = 6

WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Character classes: what the whole candidate is made of, and the entropy in bits from which a window
#: counts. Random keys of 20 characters with a digit and a letter stay below in under 5 of 100 cases.
CLASSES = (
    (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.47),
    (r"", 3.74),
)
#: Candidates that are no secrets: UUIDs, paths and slugs of plain words, numbers, words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[/_-]*[A-Za-z]+([/_-]+([A-Za-z]+|[0-9]{1,4}))*[/_-]*$",
    r"^[0-9+/_-]+$",
    r"^[A-Za-z]?[a-z]+[0-9]{0,4}$",
)
#: Marks of examples: no window with one counts.
EXAMPLE = r"(?i:example|placeholder)|(.)\1{5}"

_SPAN = "array<struct<start:int,kind:int,end:int,name:string>>"


def _matches(text: Column, pattern: str, group: int, keep) -> Column:
    """(start, end, value) of the matches that ``keep`` accepts; value is the group's text.

    Match texts and the parts between them alternate, so their lengths add up to places.
    """

    def placed(found: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.char_length(F.get(found["between"], i))
            end = start + F.char_length(F.get(found["whole"], i))
            one = F.struct(start.alias("start"), end.alias("end"), F.get(found["value"], i).alias("value"))
            return F.struct(end.alias("at"), F.array_append(acc["spans"], one).alias("spans"))

        first = F.struct(
            F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)").alias("spans")
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(found["whole"]) - 1), first, step, lambda acc: acc["spans"])

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("between"),
    )
    return F.when(text.rlike(pattern), F.filter(let(found, placed), keep)).otherwise(
        F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")
    )


def _named(spans: Column, kind: int, name: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.lit(name).alias("name")
        ),
    )


def _max_entropy(value: Column) -> Column:
    """The largest entropy in bits of a window of the string, from running counts."""
    zeros = F.expr(f"array_repeat(0, {len(ALPHABET)})")

    def weight(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))

    def slide(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.get(codes, i - WINDOW)
            full = i >= WINDOW

            def moved(n_new: Column) -> Column:
                gained = acc["mass"] + weight(n_new + 1) - weight(n_new)
                added = F.transform(acc["counts"], lambda n, j: F.when(j == new, n + 1).otherwise(n))

                def without(counts: Column) -> Column:
                    n_old = F.get(counts, old)
                    mass = F.when(full, gained + weight(n_old - 1) - weight(n_old)).otherwise(gained)
                    left = F.when(
                        full, F.transform(counts, lambda n, j: F.when(j == old, n - 1).otherwise(n))
                    ).otherwise(counts)
                    entropy = F.log2(F.lit(float(WINDOW))) - mass / WINDOW
                    best = F.when(i >= WINDOW - 1, F.greatest(acc["best"], entropy)).otherwise(acc["best"])
                    return F.struct(left.alias("counts"), mass.alias("mass"), best.alias("best"))

                return let(added, without)

            return let(F.get(acc["counts"], new), moved)

        first = F.struct(zeros.alias("counts"), F.lit(0.0).alias("mass"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), first, step, lambda acc: acc["best"])

    # The split ends with an empty part, which is no character.
    letters = F.filter(F.split(value, "(?!^)"), lambda ch: ch != "")
    return let(F.transform(letters, lambda ch: F.position(ch, F.lit(ALPHABET)) - 1), slide)


def _suspicious(value: Column) -> Column:
    """Whether a candidate is not allowed and has a window that counts."""
    plain = F.lit(False)
    for pattern in ALLOWED:
        plain = plain | value.rlike(pattern)
    *named, (_, rest) = CLASSES
    least = F.lit(rest)
    for pattern, bits in reversed(named):
        least = F.when(value.rlike(pattern), bits).otherwise(least)

    def counts(part: Column) -> Column:
        long = F.char_length(part) >= WINDOW
        return long & part.rlike("[0-9]") & part.rlike("[A-Za-z]") & (_max_entropy(part) >= least)

    return ~plain & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & F.exists(F.split(value, EXAMPLE), counts)


def _blanked(text: Column, found: Column) -> Column:
    """The text with blanks in place of the characters of all spans."""

    def step(acc: Column, s: Column) -> Column:
        start = F.greatest(acc["at"], s["start"])
        between = F.substring(text, acc["at"] + 1, start - acc["at"])
        blanks = F.repeat(F.lit(" "), F.greatest(s["end"] - start, F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], between, blanks).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(found, first, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)


def spans(text: Column) -> Column:
    """All spans of a text by start: base kinds 0 to 2, then kind 3 for entropy."""
    text = F.coalesce(text, F.lit(""))

    def scan(t: Column) -> Column:
        base = F.concat(
            _named(_matches(t, ASSIGN, 1, lambda s: F.char_length(s["value"]) >= MIN_VALUE), 0, "assign"),
            _named(_matches(t, ACCESS, 0, lambda s: F.lit(True)), 1, "access"),
            _named(_matches(t, HEX, 0, lambda s: F.lit(True)), 2, "hex"),
        )

        def with_entropy(known: Column) -> Column:
            def of_rest(rest: Column) -> Column:
                return _named(_matches(rest, CANDIDATE, 0, lambda s: _suspicious(s["value"])), 3, "entropy")

            return let(_blanked(t, known), lambda rest: F.sort_array(F.concat(known, of_rest(rest))))

        return let(F.sort_array(base), with_entropy)

    return let(text, scan)


def listed(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with each run of overlapping spans replaced by the mark."""

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return (
            F.when(
                s["start"] >= acc["at"],
                F.struct(s["end"].alias("at"), F.concat(acc["out"], between, F.lit(mark)).alias("out")),
            ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        found, first, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    )
    return F.when(F.size(found) > 0, done).otherwise(text)


def scan(documents: DataFrame, *keep: str) -> DataFrame:
    """The named columns of the documents and ``found``, the spans of their texts."""
    return documents.select(*keep, F.explode(F.array(spans(F.col("text")))).alias("found"))
