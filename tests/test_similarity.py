"""The similarity join against brute force: common passages, near copies, copies and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tamiz.operators import similarity


def shingle_set(text, n=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(texts, least=0.8):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    heads = {}
    for k in sorted(sets):
        heads.setdefault(sets[k], k)
    found = set()
    for a, x in heads.items():
        for b, y in heads.items():
            common = len(a & b)
            if x < y and common and common >= least * len(a | b):
                found.add((x, y, common, len(a), len(b)))
    return found, {k: heads[s] for k, s in sets.items()}


@pytest.fixture(scope="module")
def texts():
    """A passage that most texts share, near copies of one text, copies and short and empty texts."""
    random.seed(4)
    word = lambda: f"w{random.randrange(400)}"
    passage = " ".join(word() for _ in range(40))
    base = [word() for _ in range(120)]
    found = {}
    for i in range(60):
        found[len(found)] = " ".join(word() for _ in range(20)) + " " + passage + f" end{i}"
    for i in range(60):
        near = list(base)
        for _ in range(random.randrange(5)):
            near[random.randrange(len(near))] = word()
        found[len(found)] = " ".join(near[: random.randrange(100, 121)])
    for i in range(40):
        found[len(found)] = found[61] if i % 2 else found[61].upper().replace(" ", ", ")
    for text in (None, "", " .,! ", "one two", "One, two!", "one two three four five", "é ñ Ü 1 2 3"):
        found[len(found)] = text
    return found


@pytest.mark.parametrize("common", [2, 20, 10_000])
def test_pairs_equal_brute_force(spark, texts, common):
    """Whatever counts as common; the pairs include near copies of several lengths."""
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "k long, text string, clase string").repartition(3)
    got = [tuple(r) for r in similarity.similar_pairs(df, "k", "text", common=common).collect()]
    want, _ = brute(texts)
    assert len(want) > 30 and len(got) == len(set(got)) and set(got) == want


def test_classes_and_links(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "k long, text string")
    got = {r.k: (r.clase, r.enlaces) for r in similarity.similar_texts(df.union(df.limit(3)).distinct(), "k", "text").collect()}
    pairs, heads = brute(texts)
    assert got == {k: (h, sum(h in p[:2] for p in pairs)) for k, h in heads.items()}


def test_empty_table_and_repeated_rows(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "k long, text string")
    assert similarity.similar_pairs(df.limit(0), "k", "text").count() == 0
    assert similarity.similar_texts(df.limit(0), "k", "text").count() == 0
    twice = {tuple(r) for r in similarity.similar_pairs(df.union(df), "k", "text", common=5).collect()}
    assert twice == brute(texts)[0]


def test_bitmap_never_rejects_and_prunes(spark):
    """The bound behind the bitmap filter is at least the true overlap, and low for sets far apart."""
    df = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(150))), (2, " ".join(f"a{i}" if i % 9 else f"b{i}" for i in range(150)))], "k long, text string")
    sets = similarity.text_sets(df, "k", "text")
    a, b = sets.where("key = 1").alias("a"), sets.where("key = 2").alias("b")
    most = F.least(F.col("a.tamano") - similarity._only("a", "b"), F.col("b.tamano") - similarity._only("b", "a"))
    bound = a.crossJoin(b).select(most).first()[0]
    x, y = (shingle_set(t) for _, t in df.collect())
    assert len(x & y) <= bound < len(x) - 20


def test_sets_are_sorted_as_numbers(spark):
    """No part of a set may hold nulls: only then are its numbers sorted without a lambda for every two."""
    df = spark.createDataFrame([(1, "a b c d e f g"), (2, "one two"), (3, " ,"), (4, None)], "k long, text string")
    sets = similarity.sets_of(df, "k", "text", 5)
    assert not sets.schema["set"].dataType.containsNull
    got = {r.key: r.set for r in sets.collect()}
    assert {k: len(s) for k, s in got.items()} == {1: 3, 2: 1, 3: 0, 4: 0} and got[1] == sorted(got[1])


def test_bitmap_words_are_stretches_of_the_set(spark):
    """Highest bits give the word, the lowest six the bit; also at the bounds between words."""
    wide = 2**64 // similarity.BITMAP_WORDS
    ends = [w * wide - 2**63 + d for w in range(similarity.BITMAP_WORDS + 1) for d in (-1, 0, 1)]
    random.seed(7)
    tokens = [t for t in ends if -(2**63) <= t < 2**63] + [random.randrange(-(2**63), 2**63) for _ in range(300)]
    for chosen in ([], [-(2**63)], [2**63 - 1], sorted(set(tokens))):
        df = spark.createDataFrame([(1, chosen)], "key long, set array<bigint>")
        want = [0] * similarity.BITMAP_WORDS
        for t in chosen:
            want[(t + 2**63) // wide] |= 1 << (t & 63)
        got = similarity._with_bitmap(df).select(*similarity.BITMAP).first()
        assert [g % 2**64 for g in got] == want


def test_near_copies_are_compared_by_differences(spark, texts):
    """One centre for a group of near copies; what is joined to its pairs is a small part of the sets."""
    rows = [(k, t) for k, t in texts.items() if 60 <= k < 120]
    sets = similarity.sets_of(spark.createDataFrame(rows, "k long, text string"), "k", "text", 5)
    sets = sets.withColumnRenamed("key", "clase").cache()
    a, b = (sets.select(F.col("clase").alias(f"clase_{x}")) for x in "ab")
    pairs = a.join(b, F.col("clase_a") < F.col("clase_b"))
    centres = similarity._centres(pairs)
    assert centres.count() == 60 and centres.select("centro").distinct().count() == 1
    parts = similarity._differences(sets, centres).selectExpr("sum(size(menos) + size(mas))", "sum(tamano)").first()
    assert parts[0] < 0.5 * parts[1]
    made = {k: shingle_set(t) for k, t in rows}
    # All pairs, then few of them, so that some have two centres.
    for some in (pairs, pairs.where("(clase_a * clase_b) % 7 = 1")):
        got = {(r.clase_a, r.clase_b): (r.comunes, r.tamano_a, r.tamano_b) for r in similarity._overlaps(some, sets).collect()}
        asked = [tuple(r) for r in some.select("clase_a", "clase_b").collect()]
        assert got == {(x, y): (len(made[x] & made[y]), len(made[x]), len(made[y])) for x, y in asked}
    assert similarity._centres(some).select("centro").distinct().count() > 1


def test_keys_are_enough():
    """Of two sets that are alike, however the shingles differ, the first keys share one."""
    for n in range(1, 40):
        for m in range(n, 60):
            common = -(-8 * (n + m) // 18)  # least overlap of a pair that is alike
            if common > n:
                continue
            keys = [size - -(-8 * size // 10) + 1 for size in (n, m)]
            # The worst order puts all shingles of one set alone first.
            assert n - common < keys[0] and m - common < keys[1]
