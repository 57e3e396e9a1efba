"""SimHash near-duplicates found by a self-join of the binary trie of fingerprints.

Two fingerprints link if they differ in few bits. The trie of all distinct
fingerprints is traversed against itself: a pair of nodes carries the bits in
which its two paths differ so far and is dropped once they exceed the budget.
Spark deals the top levels: every subtree is one group, and a fingerprint
visits each subtree whose path is within the budget of its own. Tasks walk the
levels below. A subtree with too many fingerprints is opened further before
that, so a group stays within memory however fingerprints crowd together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches, components, frozen, free_name, lean

BITS = 64
#: Pairs of nodes that a task holds at once.
FRONTIER = 200_000
SHINGLE_BLOCK = 32_768


def text_fingerprint(data: bytes, shingle: int) -> int:
    """Fingerprint of one text as a signed 64-bit integer; no word gives 0."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        return int(np.array([digest(text, 42)], np.uint64).view(np.int64)[0])
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -shingle] + 1)).tolist()
    ends = ends[shingle - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), SHINGLE_BLOCK):
        spans = zip(starts[k : k + SHINGLE_BLOCK], ends[k : k + SHINGLE_BLOCK])
        hashes = np.array([digest(text[a:b], 42) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a column of 64-bit SimHash fingerprints (long) of lower-cased word shingles.

    Only A-Z are lower-cased, words are runs of characters other than ASCII
    white space, and repeated shingles count each time. Fewer words than
    ``shingle`` form one shingle; null, empty and blank texts get 0. ``name``
    must be new.
    """

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array([text_fingerprint(t or b"", shingle) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    bounded_batches(docs)
    return docs.withColumn(name, fingerprint(F.col(f"`{text}`")))


def trie_links(home: np.ndarray, other: np.ndarray, budget: int):
    """Blocks of index pairs (i, j) with ``home[i]`` and ``other[j]`` at most ``budget`` bits apart.

    Both are sorted arrays of distinct unsigned fingerprints, that is tries
    whose nodes are ranges. A frontier of node pairs descends one bit at a
    time; ranges split where the bit turns to 1.
    """

    def split(values, lo, hi, bit):
        one = np.uint64(1 << bit)
        keep = ~np.uint64((1 << (bit + 1)) - 1) if bit < 63 else np.uint64(0)
        middle = np.searchsorted(values, (values[lo] & keep) | one)
        return np.clip(middle, lo, hi)

    if not len(home) or not len(other):
        return
    whole = np.zeros(1, np.int64)
    stack = [(BITS - 1, whole, whole + len(home), whole, whole + len(other), whole)]
    while stack:
        bit, a0, a1, b0, b1, apart = stack.pop()
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if bit < 0:
            single[:] = True
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(home[i] ^ other[j]) <= budget
            yield i[near], j[near]
            rest = ~single
            a0, a1, b0, b1, apart = a0[rest], a1[rest], b0[rest], b1[rest], apart[rest]
        if not len(a0):
            continue
        am, bm = split(home, a0, a1, bit), split(other, b0, b1, bit)
        children = []
        for x0, x1, y0, y1, more in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            go = (x0 < x1) & (y0 < y1) & (apart + more <= budget)
            children.append((x0[go], x1[go], y0[go], y1[go], apart[go] + more))
        joined = [np.concatenate(c) for c in zip(*children)]
        for k in range(0, len(joined[0]), FRONTIER):
            stack.append((bit - 1, *(c[k : k + FRONTIER] for c in joined)))


def forest(n: int, blocks) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) for the linked ones of ``n`` nodes."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in blocks:
        for x, y in zip(i.tolist(), j.tolist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(x, root) for x in range(n) if (root := find(x)) != x]


def links(fingerprints: DataFrame, budget: int, subtree: int = 2048, crowded: int = 50_000) -> DataFrame:
    """Links (u, v) that connect all distinct ``fingerprint`` values at most ``budget`` bits apart.

    Each task reduces its links to the trees that they span, so a crowd of
    near-identical fingerprints yields a link per member and not per pair; what
    is reachable stays the same. ``subtree`` is the wished number of
    fingerprints below a node, ``crowded`` the number from which a node is
    opened by four more levels.
    """
    distinct = fingerprints.select("fingerprint").distinct()
    depth = min(BITS, max(1, math.ceil(math.log2(max(2, fingerprints.count() / subtree)))))

    def prefix(bits: int):
        return F.shiftrightunsigned("fingerprint", BITS - bits)

    masks = [0] + [1 << a for a in range(depth)]
    if budget > 1:
        masks += [1 << a | 1 << b for a in range(depth) for b in range(a)]
    if budget > 2:
        raise ValueError("a budget of up to 2 bits is supported")
    if not budget:
        masks = [0]
    visits = distinct.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    visits = visits.select(
        "fingerprint",
        prefix(depth).bitwiseXOR(F.col("mask")).alias("node"),
        F.bit_count("mask").alias("apart"),
    ).where((F.col("apart") == 0) | (prefix(depth) > F.col("node")))

    def walk(table: pa.Table) -> pa.Table:
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        order = np.argsort(values)
        values, own = values[order], table.column("apart").to_numpy()[order] == 0
        at = np.flatnonzero(own)
        blocks = ((at[i], j) for i, j in trie_links(values[at], values, budget))
        tree = forest(len(values), blocks)
        u, v = (np.array(x, np.int64) for x in (zip(*tree) if tree else ((), ())))
        signed = values.view(np.int64)
        return pa.table({"u": signed[u], "v": signed[v]})

    found = None
    while True:
        sizes = visits.groupBy("node").agg(F.count(F.when(F.col("apart") == 0, 1)).alias("own"), F.count("*").alias("n"))
        # a group without fingerprints of its own has nothing to compare
        heavy = frozen(sizes.where((F.col("n") > crowded) & (F.col("own") > 0)).select("node"), "trie-crowded")
        more = depth < BITS and heavy.limit(1).count() > 0
        light = visits.join(heavy, "node", "left_anti") if more else visits
        part = light.groupBy("node").applyInArrow(lean(walk), "u long, v long")
        found = part if found is None else found.unionByName(part)
        if not more:
            return found
        step = min(4, BITS - depth)
        depth += step
        opened = visits.join(heavy, "node", "left_semi")
        opened = opened.withColumn("leaf", F.explode(F.sequence(F.lit(0), F.lit((1 << step) - 1)).cast("array<bigint>")))
        node = F.shiftleft("node", step).bitwiseOR(F.col("leaf"))
        visits = opened.select(
            "fingerprint",
            node.alias("node"),
            F.bit_count(prefix(depth).bitwiseXOR(node)).alias("apart"),
        ).where((F.col("apart") <= budget) & (prefix(depth) >= F.col("node")))


def near_duplicates(marked: DataFrame, budget: int = 2, doc_id: str = "doc_id") -> DataFrame:
    """``marked`` with ``component_id``, the smallest doc_id reachable over links.

    ``marked`` has a doc_id and a ``fingerprint`` column and is read several
    times, so it should be a written table. Rows of one fingerprint are always
    linked. Null ids do not count for the smallest; a component of nulls alone
    has a null id. No row is dropped and none is repeated.
    """
    own = marked.groupBy("fingerprint").agg(F.min(F.col(f"`{doc_id}`")).alias("first_id"))
    own = frozen(own, "simhash-distinct")
    roots = components(links(own, budget), "simhash-links").withColumnRenamed("u", "fingerprint")
    rooted = own.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = frozen(rooted, "simhash-rooted")
    least = frozen(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-least")
    classes = frozen(rooted.join(least, "root").select("fingerprint", "component_id", "root"), "simhash-classes")
    return marked.join(classes, "fingerprint", "left")


def places(docs: DataFrame) -> tuple[Column, Column] | None:
    """What tells the rows of a table in files apart (hash of the file, row within it); None where there are no files."""
    try:
        known = docs.metadataColumn("_metadata")
        file, at = F.xxhash64(known["file_path"]), known["row_index"]
        docs.select(file, at)
    except AnalysisException:
        return None
    return file, at


def keep_one(
    docs: DataFrame,
    shingle: int = 3,
    budget: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    written: bool = False,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of every component stays.

    It is the row with the smallest doc_id; of rows with equal ids one (null
    ids come last). Columns are those of ``docs``; a table without rows stays
    empty.

    Rows are told apart by their place in files, so ``docs`` is written first
    unless ``written`` says that it is no more than the read of a table. Texts
    are read twice and shuffled once, by place, at every size of the input.
    """
    columns = [f"`{c}`" for c in docs.columns]
    place = places(docs) if written else None
    if place is None:
        docs = frozen(docs, "simhash-rows")
        place = places(docs)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), place[0].alias("file"), place[1].alias("at"))
    marked = frozen(with_fingerprint(narrow, shingle).drop("text"), "simhash-fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "file", "at")
    first = near_duplicates(marked, budget).groupBy("root").agg(F.min(order).alias("first"))
    file, at = free_name(docs, "file_of_table"), free_name(docs, "row_of_file")
    kept = frozen(first.select(F.col("first.file").alias(file), F.col("first.at").alias(at)), "simhash-kept")
    placed = docs.withColumns({file: place[0], at: place[1]})
    return placed.join(kept.hint("shuffle_hash"), [file, at], "left_semi").select(*columns)
