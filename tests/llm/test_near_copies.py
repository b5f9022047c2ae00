"""Near copies of the pipeline against the exact similarity of all pairs."""

import random

import brute
import corpus_pipeline
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {" ".join(w)} - {""}


def prose(n, seed):
    draw = random.Random(seed)
    return [f"w{draw.randrange(50_000)}" for _ in range(n)]


def changed(n, tail, seed):
    """A text with n shingles and a copy whose last ``tail`` shingles differ."""
    words = prose(n + 4, seed)
    return " ".join(words), " ".join(words[: n + 4 - tail] + prose(tail, -seed - 1))


def kept(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], DOCS).repartition(5)
    return sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect())


@pytest.mark.parametrize(("n", "tail", "similarity", "copies"), [(90, 10, 0.8, 1), (185, 15, 0.85, 1), (190, 10, 0.9, 1), (179, 21, 0.79, 2)])
def test_planted(spark, n, tail, similarity, copies):
    pairs = [changed(n, tail, seed) for seed in range(60)]
    a, b = map(shingles, pairs[0])
    assert len(a & b) / len(a | b) == similarity
    texts = [t for pair in pairs for t in pair]
    assert kept(spark, texts) == [i for i in range(len(texts)) if copies == 2 or i % 2 == 0]


def test_all_pairs(spark):
    draw = random.Random(5)
    base = prose(150, 1000)
    texts = [" ".join(prose(3 + i, 2000 + i)) for i in range(60)]
    for i in range(140):  # a dense group at all similarities, linked through one another
        words = list(base)
        for _ in range(1 + i % 12):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9999)}"
        texts.append(" ".join(words))
    texts += [None, "", " ", "one two", "ONE two", "one two three", texts[4].upper(), texts[9], texts[9]]
    sets = [shingles(t) for t in texts]
    near = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a == b or 5 * len(a & b) >= 4 * len(a | b)
    ]
    groups = brute.joined(range(len(texts)), near)
    assert kept(spark, texts) == sorted(min(g) for g in groups)
    assert any(len(g) > 20 for g in groups)


def pairs_and_groups(texts):
    sets = [shingles(t) for t in texts]
    near = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or 5 * len(a & b) >= 4 * len(a | b)]
    return brute.joined(range(len(texts)), near)


@pytest.mark.parametrize("part", [2048, 16])
def test_crowded_bucket_of_unlike_texts(spark, monkeypatch, part):
    """Many texts around one passage: most pairs share buckets and are no near copies, some are."""
    from pricewatch.llm import near_copies

    monkeypatch.setattr(near_copies, "PART", part)
    draw = random.Random(8)
    passage = prose(100, 77)
    texts = []
    for i in range(160):
        words = list(passage)
        for _ in range(draw.choice([0, 1, 1, 2, 5, 9])):
            words[draw.randrange(len(words))] = f"y{draw.randrange(99999)}"
        texts.append(" ".join(words + prose(draw.choice([0, 0, 2, 30]), 9000 + i)))
    texts += [" ".join(passage[:60] + prose(60, 500 + i)) for i in range(40)]
    groups = pairs_and_groups(texts)
    assert kept(spark, texts) == sorted(min(g) for g in groups)
    assert len(groups) > 60 and max(map(len, groups)) > 20


def test_clashing_columns_and_a_very_long_text(spark):
    from pricewatch.llm import near_copies

    long = " ".join(prose(150_000, 4))
    texts = [long, long + " one more word", long.replace("w1", "v1", 40), "short text", None, None]
    rows = [(i, t, "k", "s", "b", "z", "r") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, signature string, bands string, size string, root string").repartition(3)
    got = near_copies.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 3, 4]
    assert near_copies.deduplicated(docs.limit(0)).count() == 0


def test_trie_join_links_what_no_band_shares(spark):
    """Pairs within the bits of the trie join are decided, also where every bucket has one member only."""
    from pyspark.sql import functions as F

    from pricewatch.llm import near_copies, simhash

    pairs = [changed(400, 4, seed) for seed in range(40)]
    texts = [t for pair in pairs for t in pair] + [" ".join(prose(60, 700)), None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "__row long, text string").repartition(3)
    made = rows.select("__row", F.explode(F.array(near_copies.sketches("text"))).alias("s")).select("__row", "s.*")
    alone = made.withColumn("bands", F.transform("bands", lambda band, i: F.xxhash64("key", i)))
    links = {frozenset((r.vertex, r.root)) for r in near_copies.linked(rows, alone).collect()}
    sets = [near_copies.shingles(t) for t in texts]
    bits = [(simhash.majority(a) ^ simhash.majority(b)).bit_count() for a, b in zip(sets[:80:2], sets[1:80:2], strict=True)]
    near = [i for i, n in enumerate(bits) if n <= simhash.BUDGET]
    assert len(near) > 30
    key = {r["__row"]: r.key for r in made.collect()}
    assert links == {frozenset((key[2 * i], key[2 * i + 1])) for i in near}


def test_sketches_ship_to_executors_without_the_library(spark):
    from pyspark import cloudpickle

    from pricewatch.llm import near_copies, simhash

    for module in (near_copies, simhash):
        cloudpickle.register_pickle_by_value(module)
    try:
        assert cloudpickle.dumps(near_copies.sketches.func)
    finally:
        for module in (near_copies, simhash):
            cloudpickle.unregister_pickle_by_value(module)
