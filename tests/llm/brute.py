"""Plain Python answers for the corpus operators."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def measures(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    out = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))
    return (*out, len(w) < 10 or 100 * len(covered) > 20 * len(w))


def base_secrets(text):
    text = text or ""
    found = []
    assign = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    assign = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", assign.replace(r"\x20", " "))
    for m in re.finditer(assign + "([A-Za-z0-9+/_.=-]+)", text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    name = ("assign", "access", "hex")
    listed = ",".join(f"{name[k]}:{s}:{e}" for s, k, e in found)
    return (*(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(listed.encode()).hexdigest(), listed)


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Target words by source, from {source: words}."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_sources, out = share * sum(sizes.values()), list(order), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        over = [s for s in open_sources if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_sources}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_sources = [s for s in open_sources if s not in over]
    return out


def simhash(text):
    from xxhash import xxh64_intdigest

    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def joined(values, pairs):
    """The partition of values that the pairs make, as a set of frozensets."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in groups.values()}


def partition(rows, budget=4):
    """Fingerprints by components of links of up to ``budget`` bits."""
    values = sorted({v for _, v in rows})
    return joined(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= budget])


def components(rows):
    """(doc_id, smallest doc_id of its component) for (doc_id, fingerprint)."""
    group = {v: g for g in partition(rows) for v in g}
    low = {}
    for doc_id, v in rows:
        if doc_id is not None:
            low[group[v]] = min(doc_id, low.get(group[v], doc_id))
    return [(doc_id, low.get(group[v])) for doc_id, v in rows]
