"""Entropy spans of the secret scan against plain Python."""

import math
import random
import re
import string
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from pricewatch.llm import secret_scans as scans

LOWER, UPPER, MIXED = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.ascii_letters + string.digits


def entropy(text):
    return math.log2(len(text)) - sum(n * math.log2(n) for n in Counter(text).values()) / len(text)


def is_secret(value):
    if any(re.search(p, value) for p in scans.ALLOWED):
        return False
    least = next(bits for pattern, bits in scans.CLASSES if re.search(pattern, value))
    parts, at = [], 0
    for m in re.finditer(scans.EXAMPLE, value):
        parts.append(value[at : m.start()])
        at = m.end()
    parts.append(value[at:])
    return any(
        re.search("[0-9]", p) and re.search("[A-Za-z]", p) and max(entropy(p[i : i + 20]) for i in range(len(p) - 19)) >= least
        for p in parts if len(p) >= 20
    )


def spans(text):
    base = [tuple(x.split(":")) for x in brute.base_secrets(text)[4].split(",") if x]
    rest = list(text)
    for _, start, end in base:
        rest[int(start) : int(end)] = " " * (int(end) - int(start))
    rest = "".join(rest)
    found = [(int(s), ("assign", "access", "hex").index(k), int(e), k) for k, s, e in base]
    found += [(m.start(), 3, m.end(), "entropy") for m in re.finditer(scans.CANDIDATE, rest) if is_secret(m[0])]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = scans.scan(docs, "doc_id").select("doc_id", scans.listed(F.col("found")).alias("s")).orderBy("doc_id").collect()
    return [r.s for r in rows]


def test_entropy_spans(spark):
    draw = random.Random(1)

    def key(n, letters=MIXED):
        return "".join(draw.choices(letters, k=n))

    texts = ["", "11112222aa1111222211", "gtzynps2sorbbz9vogs9 at7nhpbhpriihqka4uxg", "AAAAAAAAAAAAAAAAAAAA1", key(19), key(20)]
    texts += [" ".join(key(40) for _ in range(10)), " and ".join(key(draw.randrange(18, 26), a) for _ in range(12) for a in (LOWER, UPPER, MIXED))]
    texts += [key(60) + "AAAAAA" + key(60), key(15) + "example" + key(15), key(30) + "PlaceHolder" + key(8), "example" + key(25) + "bbbbbbb"]
    texts += ["token=" + key(30) + "!" + key(30), key(25) + "/password:" + key(12) + "=" + key(25), "AKIA" + key(16, UPPER) + "/" + key(24)]
    texts += [key(10, "abcdef0123456789") * 3 + "xyz" + key(24), "0123456789abcdef" * 2 + "/" + key(30), "é😀 " + key(33) + "日本 " + key(20)]
    texts += ["a" * 20 + key(20), key(20) + "a" * 20, "1a" * 30 + key(18), "usr/local/share/2024/things/of/some/kind", "a550e840-e29b-41d4-a716-446655440000"]
    texts += ["".join(draw.choices("aab1" + MIXED[: draw.randrange(1, 30)], k=draw.randrange(20, 60))) for _ in range(150)]
    texts += [" ".join(key(draw.randrange(10, 45), draw.choice([LOWER, UPPER, MIXED, MIXED + "+/_-"])) for _ in range(8)) for _ in range(40)]
    assert scanned(spark, texts) == [spans(t) for t in texts]


@pytest.mark.parametrize("alphabet", [LOWER, UPPER, MIXED, string.ascii_uppercase + "234567"])
def test_random_keys_are_found(spark, alphabet):
    draw = random.Random(7)
    keys = ["".join(draw.choices(alphabet, k=20)) for _ in range(3000)]
    keys = [k for k in keys if re.search("[0-9]", k) and re.search("[A-Za-z]", k) and not re.search("AKIA", k)]
    found = sum(s == "entropy:0:20" for s in scanned(spark, keys))
    assert found >= 0.95 * len(keys)


def test_redaction_leaves_no_key(spark):
    draw = random.Random(3)
    keys = ["".join(draw.choices(MIXED, k=40)) for _ in range(8)]
    row = spark.createDataFrame([(" ".join(keys),)], "text string").select(scans.redacted(F.col("text"), scans.spans(F.col("text"))))
    assert row.first()[0] == " ".join(["[secret]"] * 8)
