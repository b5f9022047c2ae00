"""Prefix trie, divergence audit and vector near-duplicates against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from pricewatch.llm import divergence, near_vectors, prefix_trie

# Names that the operators use inside come as extra columns.
CONVERSATIONS = "conv_id long, turn long, role string, text string, c long, at string, h1 string, w string, depth string, __row string"


def trie(rows):
    """Nodes from (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(brute.words(p[-1][1])) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(spark, rows):
    table = spark.createDataFrame([(*r, 1, "a", "b", "c", "d", "e") for r in rows], CONVERSATIONS).repartition(7)
    return sorted(tuple(r[c] for c in NODE) for r in prefix_trie.trie(table).collect())


def conversations():
    draw = random.Random(1)
    said = [f"say {i} " + "word " * i for i in range(3)] + ["", None, "Ünï 日本 😀"]
    rows = []
    for c in [*range(90), 1000, 1001, 1033, -5, -20, 10**12]:
        for turn in range(draw.choice([1, 1, 2, 4, 6])):
            rows.append((c, turn if turn else draw.choice([0, None]), draw.choice(["user", None]), draw.choice(said)))
    for c in range(200, 260):  # copies of one conversation
        rows += [(c, t, "user", f"same {t}") for t in range(5)]
    rows += [(300, t, "user", f"long {t % 7}") for t in range(60)]
    rows += [(301, t, "user", f"long {t % 7}") for t in range(75)]
    rows += [(302, 4, "user", "twice")] * 9 + [(None, 1, "user", "none")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_trie(spark, monkeypatch, small):
    if small:  # many chunks and runs, and a sketch that proves next to nothing
        for name, value in (("CHUNK", 3), ("RUN", 4), ("MIN_CELLS", 64), ("MAX_CELLS", 64), ("BLOCK", 64), ("HOT", 2)):
            monkeypatch.setattr(prefix_trie, name, value)
    rows = conversations()
    assert nodes(spark, rows) == trie(rows)


def test_trie_of_little(spark):
    assert nodes(spark, []) == []
    # Conversation 3 keeps none of its turns and its donor is absent: it ends at the root.
    few = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(few, 1, "user", "a b"), (40, 1, None, None)]
    assert nodes(spark, rows) == trie(rows)
    assert any(r[1] == 0 and r[7] == hashlib.sha256(str(few).encode()).hexdigest() for r in nodes(spark, rows))


def audit(docs):
    """Rows from (text, lang, source) documents."""
    docs = [tuple(x or "" for x in d) for d in docs]
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    found = [term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) for text, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        of = Counter(t for (_, l, _), f in zip(docs, found, strict=True) if l == lang for t in set(f))
        kept = [t for t, n in of.items() if n >= 10]
        count = {s: Counter() for _, l, s in docs if l == lang}
        for (_, l, s), f in zip(docs, found, strict=True):
            if l == lang:
                count[s].update(t for t in f if of[t] >= 10)

        def shares(c):
            n, v = sum(c.values()), len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(c) for s, c in count.items()}
        q = shares(sum(count.values(), Counter()))
        for s in count:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in count if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(items)]
    return sorted(out)


DOCS = "doc_id long, text string, lang string, source string, idx string, term string, total string, terms string, vector string, p string"


def audited(spark, docs):
    table = spark.createDataFrame([(i, *d, "1", "2", "3", "4", "5", "6") for i, d in enumerate(docs)], DOCS).repartition(6)
    rows = divergence.audit(table).collect()
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows)


def prose_of_sources():
    draw = random.Random(2)
    words = ["Alpha", "beta", "GAMMA", "été", "ÉTÉ", "straße", "日本", "x", "tie", "eit", "x7y", "it's", "z_z", "q\x00r"]
    docs = []
    for i in range(160):
        lang = draw.choice(["en", "en", "en", None, "a b", "de"])
        source = draw.choice(["s1", "s2", "s3", "é", "Z", None])
        text = " ".join(draw.choices(words, weights=[(hash_of(source, w) % 5) + 1 for w in words], k=draw.randrange(30)))
        docs.append((text, lang, source))
    docs += [(None, "en", "silent"), ("", "xx", "one"), ("rare words only", "xx", "two"), ("rare words only", "yy", "alone")]
    docs += [("alpha " * 20_000 + "beta", "en", "s1")] + [("alpha beta", "en", "s1")] * 40
    return docs


def hash_of(*parts):
    return zlib.crc32(repr(parts).encode())


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, monkeypatch, small):
    if small:
        for name, value in (("CELLS", 1), ("LEAST_TERMS", 3), ("SLICE", 2)):
            monkeypatch.setattr(divergence, name, value)
    docs = prose_of_sources()
    assert audited(spark, docs) == audit(docs)


def test_divergence_of_little(spark):
    assert audited(spark, []) == []
    docs = [("a", "en", "x"), ("b", "en", None)]
    assert audited(spark, docs) == audit(docs) == [("en", "", "pair", "x", 0, 1), ("en", "x", "pair", "", 0, 1)]


VECTORS = "vec_id long, embedding array<float>, label int, key string, v string, w string, cell string, n string, d1 string"


def near(spark, rows):
    table = spark.createDataFrame([(i, v, 0, *"abcdef") for i, v in rows], VECTORS).repartition(5)
    found = near_vectors.grouped(table).collect()
    low = [(r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in found]
    return sorted(low, key=str)


def near_by_pairs(rows):
    fine = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], "f4").astype("f8") for i in fine}
    unit = {i: x / np.abs(x).max() for i, x in unit.items()}
    unit = {i: x / np.linalg.norm(x) for i, x in unit.items()}
    links = [
        (a, b) for n in {len(unit[i]) for i in fine}
        for of in [[i for i in fine if len(unit[i]) == n]]
        for x in [np.stack([unit[i] for i in of])]
        for a, b in (np.array(of)[np.argwhere(np.triu(x @ x.T >= 0.9, 1))]).tolist()
    ]
    n_links = Counter(i for pair in links for i in pair)
    out = []
    for group in brute.joined(range(len(rows)), links):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        low = min(ids) if ids else None
        out += [(rows[i][0] is None, rows[i][0] or 0, n_links[i], low, rows[i][0] is not None and rows[i][0] == low) for i in group]
    return sorted(out, key=str), links


def at_cosine(base, cosine, draw):
    z = draw.normal(size=base.shape)
    z -= (z @ base) * base
    return cosine * base + math.sqrt(1 - cosine * cosine) * z / np.linalg.norm(z)


def vectors():
    draw = np.random.default_rng(3)
    base = draw.normal(size=(900, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    some = [list(map(float, x)) for x in base]
    for i in range(0, 300):  # partners at all similarities around the threshold
        some.append([float(x) for x in at_cosine(base[i], 0.86 + 0.1 * (i % 100) / 100, draw)])
    some += [[float(x) for x in at_cosine(base[400], 0.97, draw)] for _ in range(400)]  # a dense group
    some += [[float(x) for x in at_cosine(base[401], 0.93, draw)] for _ in range(120)]  # a loose group
    some += [some[402]] * 300 + [[2 * x for x in some[402]]] * 3  # equal vectors and directions
    rows = list(enumerate(some))
    rows += [(9000, None), (9001, []), (9002, [0.0] * 32), (9003, [None] + [1.0] * 31), (9004, [math.nan] * 32), (9005, [math.inf] + [0.0] * 31)]
    rows += [(9006, [1.0, 0.0]), (9007, [1.0, 0.1]), (9008, [1.0, -0.0]), (9009, [1e38] * 32), (9010, [3e38] * 32), (9010, [3e38] * 32)]
    rows += [(None, some[5]), (None, some[7]), (None, None), (9011, [1.0, 0.0, 0.0])]
    return rows


@pytest.mark.parametrize("part", [2048, 40])
def test_near_vectors(spark, monkeypatch, part):
    monkeypatch.setattr(near_vectors, "PART", part)
    rows = vectors()
    want, links = near_by_pairs(rows)
    got = near(spark, rows)
    assert len(got) == len(rows)
    # No link is invented; of those there are, the cells bring nearly all together.
    found = sum(r[2] for r in got)
    assert 0.9999 * 2 * len(links) <= found <= 2 * len(links)
    assert sum(a == b for a, b in zip(want, got, strict=True)) >= 0.995 * len(rows)


def test_near_vectors_of_little(spark):
    assert near(spark, []) == []
    assert near(spark, [(3, None), (2, [0.0])]) == sorted([(False, 3, 0, 3, True), (False, 2, 0, 2, True)], key=str)
    assert near(spark, [(3, [1.0]), (2, [2.0]), (1, [-1.0])]) == sorted(
        [(False, 3, 1, 2, False), (False, 2, 1, 2, True), (False, 1, 0, 1, True)], key=str
    )


def test_cells_bring_pairs_together(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(base)]
    rows += [(10_000 + i, [float(v) for v in at_cosine(base[i], 0.905, draw)]) for i in range(2000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8)
    found = near_vectors.grouped(table).where("n_links > 0").count()
    assert found >= 0.999 * 4000


def test_repeated_terms_of_a_group_are_looked_up_once_a_digit():
    import pyarrow as pa

    texts = ["beta " * 5, "", "alpha " * 1000, "Beta"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["s", "s", "s", "t"]), pa.array(texts)], ["lang", "source", "text"])
    rows = [r for out in divergence._digits_of_terms(iter([batch])) for r in out.to_pylist()]
    counts = {}
    for r in rows:
        for term in r["terms"]:
            counts[r["source"], term] = counts.get((r["source"], term), 0) + (1 << r["digit"])
    assert counts == {("s", "en beta"): 5, ("s", "en alpha"): 1000, ("t", "en beta"): 1}
    assert sum(len(r["terms"]) for r in rows) == 2 + 6 + 1
