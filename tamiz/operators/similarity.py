"""Exact set-similarity join of long texts (partial duplicates).

A text is the set of its shingles of neighbouring words. Two texts are alike if
at least the share ``least`` of all shingles of the two is in both.

Texts with one set form a class, so copies are compared once. Of a set
of n shingles, put in one order for all sets, the first
``n - ceil(least * n) + 1`` are its keys: sets that are alike share a key.
The order is that of a hash, but shingles that more than ``common`` sets would have
as a key come last (found in one round over all sets), so a passage that many
texts share is a key of those texts alone that hold little else. Pairs that meet at a key pass a length
filter, a bitmap filter (a bit that one set has alone is a shingle that the
other lacks) and one on the number of keys at which they meet (a key that the
other lacks, though its keys go as far, is a shingle that it lacks); none
rejects a pair that is alike. The sets of the pairs left
are made once more and compared, by their differences from the set of one class that both
meet where there is one. No pair is lost, whatever ``common`` is.

Null and blank texts have no shingles: they form one class, alike to none. A
text shorter than a shingle is one shingle. Shingles are compared by 64-bit
hash. ``key`` tells texts apart: rows
that share it have one text.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import plain
from tamiz.operators.skew import join_per_key
from tamiz.session import written

#: Words of a shingle, and the share of common shingles of texts that are alike.
WORDS, LEAST = 5, 0.8
#: A key of more sets than this is common.
COMMON = 1_000
#: 64-bit words of the bitmap of a set, a power of two.
BITMAP_WORDS = 8
BITMAP = [f"b{w}" for w in range(BITMAP_WORDS)]
SET = ["h1", "h2", "tamano"]


def word_list(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(plain(text)), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, n: int) -> Column:
    """Sorted distinct hashes of all windows of ``n`` words; a shorter list is one window.

    ``words`` should be a column of its own. Words are fetched one by one:
    ``slice`` in a lambda would copy the list for every window.
    """
    last = F.size(words) - n
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])
    )
    few = F.slice(F.array(F.xxhash64(words)), 1, F.least(F.size(words), F.lit(1)))
    # As no part may hold nulls, sort_array compares plain numbers; array_sort calls a lambda for every two.
    return F.sort_array(F.array_distinct(F.when(last >= 0, windows).otherwise(few)))


def key_count(size: Column, least: float) -> Column:
    """How many shingles of a set are its keys."""
    return (size - F.ceil(F.lit(least) * size - 1e-9) + 1).cast("int")


def sets_of(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, set, tamano) of every text. ``set`` is to be exploded by the outer form: for the plain one
    the optimizer filters by a set that it makes again, splitting the text for every window."""
    listed = df.select(F.col(key).alias("key"), word_list(F.col(text)).alias("_words"))
    found = listed.select("key", shingles(F.col("_words"), words).alias("set"))
    return found.select("key", "set", F.size("set").alias("tamano"))


def _with_bitmap(sets: DataFrame) -> DataFrame:
    """Adds the bitmap: the highest bits of a shingle give the word, the lowest six the bit.

    Each word is thus of one stretch of the sorted set, and every shingle is visited once.
    The stretches are found by sorting the set once more with the bounds between them.
    """
    wide = 2**64 // BITMAP_WORDS
    bounds = [F.lit(w * wide - 2**63).cast("long") for w in range(1, BITMAP_WORDS)]
    cut = sets.withColumn("_cut", F.sort_array(F.concat("set", F.array(*bounds))))
    places = [F.lit(0), *[F.array_position("_cut", b).cast("int") for b in bounds], F.size("_cut") + 1]
    cut = cut.withColumn("_at", F.array(*places))

    def with_bit(word: Column, token: Column) -> Column:
        return word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(63).cast("int")))

    def word(w: int) -> Column:
        begin, end = F.get("_at", F.lit(w)), F.get("_at", F.lit(w + 1))
        return F.aggregate(F.slice("_cut", begin + 1, end - begin - 1), F.lit(0).cast("long"), with_bit)

    return cut.select(*sets.columns, *[word(w).alias(BITMAP[w]) for w in range(BITMAP_WORDS)])


def text_sets(df: DataFrame, key: str, text: str, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """(key, h1, h2, tamano, inicio, bitmap), written: what the join keeps of the set of every text.

    ``h1, h2, tamano`` identify the set. ``inicio`` is its begin in order of hash: the
    keys and some more, which follow where keys are common.
    """
    spare = (F.col("tamano") / 20 + 8).cast("int")
    found = _with_bitmap(sets_of(df, key, text, words))
    return written(
        found.select(
            "key",
            F.xxhash64(F.lit(1), "set").alias("h1"),
            F.xxhash64(F.lit(2), "set").alias("h2"),
            "tamano",
            F.slice("set", 1, key_count(F.col("tamano"), least) + spare).alias("inicio"),
            *BITMAP,
        ),
        "similarity-sets",
    )


def text_classes(sets: DataFrame) -> DataFrame:
    """(key, clase) of every text: the least key that has its set."""
    classes = sets.groupBy(*SET).agg(F.min("key").alias("clase"), F.count("*").alias("n"))
    return join_per_key(sets.select("key", *SET), classes, SET, "n").select("key", "clase")


def _whole_sets(df: DataFrame, chosen: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(clase, set, tamano) of the classes in ``chosen`` (clase); of other texts no set is made.

    ``chosen`` is written, so that its size is known: texts are not shuffled for a short list.
    """
    chosen = written(chosen, "similarity-asked")
    texts = df.select(F.col(key).alias("clase"), F.col(text).alias("_text")).join(chosen, "clase", "left_semi")
    return sets_of(texts, "clase", "_text", words).withColumnRenamed("key", "clase")


def _keys(
    df: DataFrame, heads: DataFrame, key: str, text: str, words: int, least: float, common: int
) -> DataFrame:
    """(clase, tamano, claves, tarde): the keys of every class, common shingles last.

    ``tarde`` says whether the last of them is a common one.
    """
    size = key_count(F.col("tamano"), least)
    first = heads.select(F.explode_outer(F.slice("inicio", 1, size)).alias("token"))
    late = first.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > common).select("token")
    late = written(late, "similarity-common")

    def ordered(sets: DataFrame, tokens: str) -> DataFrame:
        """Adds ``early`` and ``late``, the tokens of a class that are not common and those that are."""
        listed = sets.select("clase", F.explode_outer(tokens).alias("token")).join(late, "token", "left_semi")
        listed = listed.groupBy("clase").agg(F.sort_array(F.collect_set("token")).alias("late"))
        none = F.array().cast("array<bigint>")
        # Written, so that its size is known: where few classes are in it, the sets stay where they are read.
        listed = written(listed, "similarity-late")
        found = sets.join(listed, "clase", "left").withColumn("late", F.coalesce("late", none))
        return found.withColumn("early", F.array_except(tokens, "late"))

    begun = written(
        ordered(heads.select("clase", "tamano", "inicio"), "inicio").select(
            "clase", "tamano", F.slice("early", 1, size).alias("claves")
        ),
        "similarity-begun",
    )
    # Classes whose begin has too few others: all their shingles are read.
    enough = F.size("claves") == size
    short = _whole_sets(df, begun.where(~enough).select("clase"), key, text, words).dropDuplicates(["clase"])
    short = written(short, "similarity-short")
    anew = ordered(short, "set").select(
        "clase",
        "tamano",
        F.slice(F.concat("early", "late"), 1, size).alias("claves"),
        (F.size("early") < size).alias("tarde"),
    )
    anew = written(anew, "similarity-anew")
    return begun.where(enough).select("clase", "tamano", "claves", F.lit(False).alias("tarde")).unionByName(anew)


def _only(a: str, b: str) -> Column:
    """Bits that ``a`` has and ``b`` lacks: at least so many shingles are in ``a`` alone."""
    return reduce(
        add, [F.bit_count(F.col(f"{a}.{w}").bitwiseAND(F.bitwise_not(F.col(f"{b}.{w}")))) for w in BITMAP]
    )


def _centres(pairs: DataFrame) -> DataFrame:
    """(clase, centro) of all classes in ``pairs``: of a class and those it meets, the one that meets most."""
    ways = [F.struct(F.col(f"clase_{x}").alias("clase"), F.col(f"clase_{y}").alias("otra")) for x, y in ("ab", "ba")]
    ends = pairs.select(F.inline(F.array(*ways)))
    degrees = written(ends.groupBy("clase").agg(F.count("*").alias("n")), "similarity-degrees")
    near = ends.join(degrees.withColumnRenamed("clase", "otra"), "otra").select("clase", "n", "otra")
    near = near.unionByName(degrees.withColumn("otra", F.col("clase")))
    # Of equals the least class, so that those that meet each other agree.
    best = F.min(F.struct(-F.col("n"), F.col("otra").alias("centro"))).alias("_best")
    return near.groupBy("clase").agg(best).select("clase", "_best.centro")


def _differences(chosen: DataFrame, centres: DataFrame) -> DataFrame:
    """(clase, centro, tamano, base, menos, mas): what a set lacks of that of its centre, and what it has besides.

    ``base`` is the size of the centre's set.
    """
    base = chosen.select(F.col("clase").alias("centro"), F.col("set").alias("_base"), F.col("tamano").alias("base"))
    found = chosen.join(centres, "clase").join(base, "centro")
    menos, mas = F.array_except("_base", "set"), F.array_except("set", "_base")
    return found.select("clase", "centro", "tamano", "base", menos.alias("menos"), mas.alias("mas"))


def _overlaps(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``pairs`` (clase_a, clase_b) with both sizes and ``comunes``, the number of shingles in both sets.

    Near copies of one text meet in pairs that grow with the square of their number, so a pair gets no whole
    sets where both have one centre R, but the differences from it, which are small:
    ``|A & B| = |R| - |R - A| - |R - B| + |(R - A) & (R - B)| + |(A - R) & (B - R)|``.
    """
    centres = written(_centres(pairs), "similarity-centres")

    def of_both(pairs: DataFrame, one: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(one.select(*[F.col(c).alias(f"{c}_{x}") for c in one.columns]), f"clase_{x}")
        return pairs

    centred = written(of_both(pairs, centres), "similarity-centred")
    differences = written(_differences(chosen, centres), "similarity-differences")
    near = centred.where("centro_a = centro_b").select("clase_a", "clase_b")
    near = of_both(near, differences.select("clase", "tamano", "base", "menos", "mas"))
    both = [F.size(F.array_intersect(f"{c}_a", f"{c}_b")) for c in ("menos", "mas")]
    near = near.withColumn("comunes", F.col("base_a") - F.size("menos_a") - F.size("menos_b") + both[0] + both[1])
    far = of_both(centred.where("centro_a <> centro_b").select("clase_a", "clase_b"), chosen)
    far = far.withColumn("comunes", F.size(F.array_intersect("set_a", "set_b")))
    names = ["clase_a", "clase_b", "tamano_a", "tamano_b", "comunes"]
    return near.select(names).unionByName(far.select(names))


def similar_pairs(
    df: DataFrame,
    key: str,
    text: str,
    words: int = WORDS,
    least: float = LEAST,
    common: int = COMMON,
    sets: DataFrame | None = None,
) -> DataFrame:
    """All pairs of classes that are alike: (clase_a, clase_b, comunes, tamano_a, tamano_b), a < b.

    ``sets`` is the result of `text_sets` if it is there already.
    """
    sets = text_sets(df, key, text, words, least) if sets is None else sets
    copies = written(text_classes(sets).where("key <> clase").select("key").distinct(), "similarity-copies")
    heads = sets.where("tamano > 0").join(copies, "key", "left_anti").withColumnRenamed("key", "clase")
    keyed = _keys(df, heads, key, text, words, least, common)
    last = keyed.select("clase", "tarde", F.element_at("claves", -1).alias("ultimo"))
    # Most keys have one holder: they go before anything is joined to them.
    keys = keyed.select(F.explode_outer("claves").alias("token"), "clase", "tamano")
    keys = keys.withColumn("n", F.count("*").over(Window.partitionBy("token")))
    shared = written(keys.where("n > 1").drop("n"), "similarity-shared")
    marked = shared.join(last, "clase").join(heads.select("clase", *BITMAP), "clase")
    a, b = marked.alias("a"), marked.alias("b")
    needed = (F.col("a.tamano") + F.col("b.tamano")) * (least / (1 + least)) - 1e-6
    most = F.least(F.col("a.tamano") - _only("a", "b"), F.col("b.tamano") - _only("b", "a"))
    met = a.join(
        b,
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.clase") < F.col("b.clase"))
        & (F.least("a.tamano", "b.tamano") >= needed)
        & (most >= needed),
    )
    of_each = [F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in ("clase", "tamano", "tarde", "ultimo")]
    met = met.select(*of_each)
    counted = met.groupBy(*met.columns).agg(F.count("*").alias("_met"))
    # Of the two the class whose keys end first: all of them that the other has are keys there too.
    first = F.struct("tarde_a", "ultimo_a") <= F.struct("tarde_b", "ultimo_b")
    size = F.when(first, F.col("tamano_a")).otherwise(F.col("tamano_b"))
    alone = key_count(size, least) - F.col("_met")
    needed = (F.col("tamano_a") + F.col("tamano_b")) * (least / (1 + least)) - 1e-6
    pairs = written(counted.where(size - alone >= needed).select("clase_a", "clase_b"), "similarity-candidates")
    ends = pairs.select(F.explode(F.array("clase_a", "clase_b")).alias("clase")).distinct()
    chosen = _whole_sets(df, ends, key, text, words).dropDuplicates(["clase"])
    chosen = written(chosen, "similarity-chosen")
    counted = _overlaps(pairs, chosen)
    alike = F.col("comunes") >= least * (F.col("tamano_a") + F.col("tamano_b") - F.col("comunes")) - 1e-6
    return counted.where(alike).select("clase_a", "clase_b", "comunes", "tamano_a", "tamano_b")


def similar_texts(
    df: DataFrame, key: str, text: str, words: int = WORDS, least: float = LEAST, common: int = COMMON
) -> DataFrame:
    """(key, clase, enlaces) of every row: its class and how many other classes are alike to it."""
    sets = text_sets(df, key, text, words, least)
    pairs = similar_pairs(df, key, text, words, least, common, sets)
    ends = F.explode(F.array("clase_a", "clase_b")).alias("clase")
    links = pairs.select(ends).groupBy("clase").agg(F.count("*").alias("enlaces"))
    found = text_classes(sets).join(links, "clase", "left").fillna(0, ["enlaces"])
    return found.select(F.col("key").alias(key), "clase", "enlaces")
