"""Merkle manifest of a dataset as a persistent tree, and proofs against tampering.

Every row is a leaf. The leaves of a source, in order of id, form a tree of
fan-out 3; the roots of the sources, in order of source, form another on top.
A tree is cut into aligned blocks of ``3 ** LEVELS`` neighbouring nodes. A
block is one row of a table and is hashed by one task; the blocks' top nodes are
the leaves of the next table, and so on until one node remains. No task sees
more than a block, however many rows a source has.

The tree is persistent: ``put`` replaces a leaf and returns a version that has
new nodes only on the leaf's path within the block; all others are those of
the first version. A changed top node continues in the block above
by the siblings on its way, which come down from the root table by table.

Defined results: a null id or source comes first and is written ``-`` like any
null field; rows that share source and id are ordered by their digest; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tamiz.llm.common import bounded_batches, frozen

FAN_OUT = 3
#: Levels of the tree inside one block: 729 leaves.
LEVELS = 6
_SIBLINGS = "array<struct<before:binary,after:binary>>"
_STEP = pa.struct([("before", pa.binary()), ("after", pa.binary())])
_WAYS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.binary()), ("way", pa.list_(_STEP))])
_TEXTS = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def combined(digests: list[bytes]) -> bytes:
    """Digest of a run of nodes: sha256 of their digests as hex text."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def runs(nodes: list[bytes]) -> list[bytes]:
    return [combined(nodes[i : i + FAN_OUT]) for i in range(0, len(nodes), FAN_OUT)]


def tree(leaves: list[bytes], alone: bool, levels: int) -> list[list[bytes]]:
    """The levels of a block, leaves first, up to its one top node.

    A block that is a whole tree ends as soon as one node remains; others have all ``levels``.
    """
    found = [leaves]
    while len(found[-1]) > 1 if alone else len(found) <= levels:
        found.append(runs(found[-1]))
    return found


def siblings(levels: list[list[bytes]], place: int) -> list[tuple[list[bytes], list[bytes]]]:
    """Per level the nodes before and after the one on the way from a leaf to the top."""
    way = []
    for nodes in levels[:-1]:
        first = place - place % FAN_OUT
        way.append((nodes[first:place], nodes[place + 1 : first + FAN_OUT]))
        place //= FAN_OUT
    return way


def put(levels: list[list[bytes]], place: int, digest: bytes) -> list[tuple[int, bytes]]:
    """A version of the block with another leaf: its copied nodes, (place, digest) per level.

    Every other node of the version is the one in ``levels``.
    """
    copied = [(place, digest)]
    for before, after in siblings(levels, place):
        place //= FAN_OUT
        copied.append((place, combined([*before, copied[-1][1], *after])))
    return copied


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Digest of a row as hex text."""
    return F.sha2(F.concat(*[encoded(x) for x in (doc_id, source, lang, n_chars, text)]), 256)


def numbered(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``place``, the number of a node in its ``tree`` by ``order``, and ``size``, the nodes of the tree.

    One sort over all tasks; a row's number is its place in its part less
    that of the tree's first row there, plus the tree's rows in parts before.
    """
    placed = frozen(nodes.orderBy("tree", *order).withColumn("row", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("part", F.shiftright("row", 33))
    pieces = placed.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")  # one row for each part that has nodes of the tree
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "tree",
        "part",
        (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("shift"),
        F.sum("n").over(of_tree).alias("size"),
    )
    found = placed.join(pieces, ["tree", "part"])
    return found.select(*nodes.columns, (F.col("row") - F.col("shift")).alias("place"), "size")


def blocks_of(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, block, size, members, top), written: ``nodes`` (tree, place, size, digest, changed, doc_id) in blocks.

    ``top`` is the digest of a block's top node.
    """
    width = FAN_OUT**levels
    member = F.struct("place", "digest", "changed", "doc_id")
    grouped = nodes.groupBy("tree", F.expr(f"place div {width}").alias("block"), "size").agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )

    def hash_blocks(batches):
        for batch in batches:
            tops = [
                tree([m["digest"] for m in row["members"]], row["size"] <= width, levels)[-1][0]
                for row in batch.select(["members", "size"]).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.binary())], names=[*batch.schema.names, "top"])

    bounded_batches(nodes)
    return frozen(grouped.mapInArrow(hash_blocks, grouped.withColumn("top", F.lit(b"")).schema), "merkle-blocks")


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of blocks, that of the nodes first; the last one has a single block for each tree."""
    width, tables = FAN_OUT**levels, [blocks_of(nodes, levels)]
    while not tables[-1].where(F.col("size") > width).isEmpty():
        tops = tables[-1].where(F.col("size") > width)
        above = tops.select(
            "tree",
            F.col("block").alias("place"),
            F.ceil(F.col("size") / width).alias("size"),
            F.col("top").alias("digest"),
            F.col("top").alias("changed"),
            F.lit(None).cast(nodes.schema["doc_id"].dataType).alias("doc_id"),
        )
        tables.append(blocks_of(above, levels))
    return tables


def descend(tables: list[DataFrame], ways: DataFrame, levels: int) -> DataFrame:
    """(tree, block, subroot, way) for every member of the first of ``tables``, as ``block``.

    ``ways`` has them for the trees (block 0). A way holds, for every level up
    to the root, the siblings before and after, each as one text of bytes.
    """
    width = FAN_OUT**levels

    def inside(batches):
        for batch in batches:
            for row in batch.to_pylist():
                nodes = tree([m["digest"] for m in row["members"]], row["size"] <= width, levels)
                found = [
                    {
                        "tree": row["tree"],
                        "block": m["place"],
                        "subroot": row["subroot"],
                        "way": [{"before": b"".join(b), "after": b"".join(a)} for b, a in siblings(nodes, k)] + row["way"],
                    }
                    for k, m in enumerate(row["members"])
                ]
                yield pa.RecordBatch.from_pylist(found, schema=_WAYS)

    found = ways
    for table in reversed(tables):
        # Trees that end in a lower table take their way there unchanged.
        whole = table.where(F.col("size") <= width).join(ways, ["tree", "block"])
        if found is not ways:
            whole = whole.unionByName(table.where(F.col("size") > width).join(found, ["tree", "block"]))
        found = whole.mapInArrow(inside, f"tree string, block bigint, subroot binary, way {_SIBLINGS}")
    return found


def folded(digest: bytes, way: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root to which a node leads by its siblings."""
    for before, after in way:
        digest = combined([*before, digest, *after])
    return digest


def _split(digests: bytes) -> list[bytes]:
    return [digests[i : i + 32] for i in range(0, len(digests), 32)]


def proofs(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    ``leaves``: source, doc_id, digest (binary) and ``changed``, the digest
    that the row has now. ``folded_root`` is the root of the version that has
    ``changed`` in the leaf's place, ``verified`` whether it is the root.
    ``proof_sha256`` digests the siblings on the way to the root, level by level.
    """
    width = FAN_OUT**levels
    # Joins pass over nulls; "" comes before every marked source.
    source = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    nodes = leaves.select(source.alias("tree"), "doc_id", "digest", "changed")
    tables = climb(numbered(nodes, [F.asc_nulls_first("doc_id"), F.asc("digest")]), levels)

    subroots = None
    for table in tables:
        ended = table.where(F.col("size") <= width).select(
            F.lit("").alias("tree"),
            F.col("tree").alias("source"),
            F.col("top").alias("digest"),
            F.col("top").alias("changed"),
            F.lit(None).cast("bigint").alias("doc_id"),
        )
        subroots = ended if subroots is None else subroots.unionByName(ended)
    subroots = numbered(subroots, [F.asc("source")])
    upper = climb(subroots, levels)
    last = upper[-1].select("top").first()
    root = last[0] if last else b""
    spark = leaves.sparkSession
    start = spark.createDataFrame([("", 0, None, [])], f"tree string, block bigint, subroot binary, way {_SIBLINGS}")
    ways = descend(upper, start, levels).select(F.col("block").alias("place"), "way")
    ways = subroots.join(ways, "place").select(
        F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("block"), F.col("digest").alias("subroot"), "way"
    )
    ways = frozen(ways, "merkle-ways")

    def prove(batches):
        for batch in batches:
            for row in batch.to_pylist():
                members = row["members"]
                nodes = tree([m["digest"] for m in members], row["size"] <= width, levels)
                above = [(_split(step["before"]), _split(step["after"])) for step in row["way"]]
                columns = {name: [] for name in ("doc_id", "leaf", "proof_sha256", "folded_root")}
                for k, m in enumerate(members):
                    way = siblings(nodes, k) + above
                    proof = "".join(d.hex() for before, after in way for d in (*before, *after))
                    version = put(nodes, k, m["changed"])
                    columns["doc_id"].append(m["doc_id"])
                    columns["leaf"].append(m["digest"].hex())
                    columns["proof_sha256"].append(hashlib.sha256(proof.encode()).hexdigest())
                    columns["folded_root"].append(folded(version[-1][1], above).hex())
                columns["subroot"] = [row["subroot"].hex()] * len(members)
                columns["root"] = [root.hex()] * len(members)
                columns["verified"] = [x == root.hex() for x in columns["folded_root"]]
                ids = pa.array(columns["doc_id"], batch.schema.field("members").type.value_type.field("doc_id").type)
                texts = [pa.array(columns[name], pa.string()) for name in _TEXTS]
                yield pa.RecordBatch.from_arrays(
                    [ids, *texts, pa.array(columns["verified"], pa.bool_())], names=["doc_id", *_TEXTS, "verified"]
                )

    schema = StructType(
        [StructField("doc_id", leaves.schema["doc_id"].dataType)]
        + [StructField(name, StringType()) for name in _TEXTS]
        + [StructField("verified", BooleanType())]
    )
    below = descend(tables[1:], ways, levels) if len(tables) > 1 else None
    first = tables[0]
    found = first.where(F.col("size") <= width).join(ways, ["tree", "block"])
    if below is not None:
        found = found.unionByName(first.where(F.col("size") > width).join(below, ["tree", "block"]))
    return found.mapInArrow(prove, schema)
