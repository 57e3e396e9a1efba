"""Resampling, neighbour search and the Merkle manifest against brute force, and on odd rows.

The queries of resampling and the manifest are held against their SQL in test_llm_operators.
"""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import common, merkle, neighbours, resampling
from tamiz.llm.workload import LLM_QUERIES

# ---- resampling


def test_sliced_sums_equal_products():
    rng = np.random.default_rng(1)
    buckets = 1000
    gain = rng.integers(-20_000, 20_000, buckets).tolist()
    counts = np.zeros((7, resampling.padded(buckets)), np.int32)
    counts[:, :buckets] = rng.integers(0, 300, (7, buckets))
    counts[0] = 0
    want = counts[:, :buckets].astype(np.int64) @ np.array(gain)
    assert resampling.sliced_sums(counts, resampling.gain_planes(gain)).tolist() == want.tolist()
    assert resampling.sliced_sums(counts, resampling.gain_planes([0] * buckets)).tolist() == [0] * 7
    assert resampling.sliced_sums(counts, resampling.gain_planes([-1] * buckets)).tolist() == (-counts.sum(1)).tolist()


def test_features_are_runs_of_words():
    assert resampling.features("Ab-c É1\x00d".encode(), 2) == (
        4,
        [w.encode() for w in ("ab", "c", "É1", "d", "ab c", "c É1", "É1 d")],
    )
    assert resampling.features(None, 3) == (0, []) == resampling.features(b" .,\n", 1)


def test_a_worker_forgets_features(monkeypatch):
    monkeypatch.setattr(resampling, "REMEMBERED", 2)
    known = resampling._Buckets(7)
    words = [str(i % 5).encode() for i in range(40)]
    assert [known[w] for w in words] == [resampling.zlib.crc32(w) % 7 for w in words]
    assert len(known) <= 2 and len(known.older) <= 2


def test_resampling_odd_rows(spark, rows_of):
    long = "word " * 30_000
    texts = [(1, long), (2, None), (3, ""), (None, long), (None, long), (5, "a b"), (5, "a b"), (7, " ".join(f"w{i}" for i in range(25)))]
    docs = rows_of([(d, t, 1, 2, 3) for d, t in texts], "doc_id long, text string, score int, bucket int, place int")
    target = rows_of([("w1 w2 word",), (None,)], "text string")
    rows = resampling.resample(docs, target, share=(100, 100)).collect()
    assert len(rows) == len(texts) and rows[0].__fields__ == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4]
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[2].n_features, by_id[2].weight, by_id[2]["rank"]) == (0, 0, None)
    assert by_id[3].weight == 0 and by_id[5].n_features == 2 and by_id[None].n_features == 30_000
    twins = [r for r in rows if r.doc_id is None]
    assert twins[0].score == twins[1].score and abs(twins[0]["rank"] - twins[1]["rank"]) == 1
    order = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in order] == sorted((r.score for r in order), reverse=True)
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(texts)


def test_ranks_go_on_over_parts(spark):
    """More rows than a part holds, a third of them with one id and text: ranks have no gaps."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same " * 25)).otherwise(F.concat_ws(" ", *[F.hash("id", F.lit(i)).cast("string") for i in range(25)])).alias("text"),
    )
    rows = resampling.resample(docs, docs.limit(3).select("text"), share=(50, 100)).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 1501))
    drawn = [(-r.score, r.doc_id) for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]
    assert drawn == sorted((-r.score, r.doc_id) for r in rows)[:1500]


# ---- neighbours


def brute(ids, vectors, query, k):
    scores = np.cumsum(vectors * vectors[ids.index(query)], axis=1)[:, -1]
    order = sorted((-s, i) for s, i in zip(scores.tolist(), ids) if i != query)[:k]
    return [(i, -s) for s, i in order]


def answers(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def recall(found, ids, vectors, queries, k):
    hits = 0
    for q in queries:
        want = brute(ids, vectors, q, k)
        assert len(found[q]) == len(want) == len({i for i, _ in found[q]}) and q not in {i for i, _ in found[q]}
        exact = dict(brute(ids, vectors, q, len(ids)))
        assert all(exact[i] == s for i, s in found[q])
        hits += len({i for i, _ in want} & {i for i, _ in found[q]}) / len(want)
    return hits / len(queries)


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_recall_of_the_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    table = common.load(spark, sf_dir, "embeddings").toArrow()
    ids = table["vec_id"].to_pylist()
    vectors = np.array(table["embedding"].to_pylist(), np.float64)
    found = answers(LLM_QUERIES["op12_neighbours"](spark, sf_dir).collect())
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(found) == sorted(queries)
    assert recall(found, ids, vectors, queries, 20) >= 0.95


def clustered(n, length=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, length))
    v = centres[rng.integers(0, 20, n)] + 0.2 * rng.normal(size=(n, length))
    return v * rng.uniform(0.2, 5, (n, 1))  # products and distances disagree


def test_small_cells_of_uneven_lengths(spark, monkeypatch):
    """Lists, cells, parts and crowds far smaller than usual: several of each."""
    for name, value in (("LIST_ROWS", 10), ("CELL_ROWS", 60), ("CELL_QUERIES", 7)):
        monkeypatch.setattr(neighbours, name, value)
    v = clustered(600)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = answers(neighbours.nearest(df, divisor=4, k=5).collect())
    assert recall(found, list(range(600)), v, range(0, 600, 4), 5) >= 0.9


def test_a_vector_that_a_third_shares(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 20)
    v = clustered(900)
    v[::3] = v[0] * 3
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    entries = neighbours.entries_of(neighbours.valid_vectors(df, "vec_id", "embedding"), 6)
    assert entries.count() == 601 and entries.agg(F.max(F.size("ids"))).first()[0] == 7
    found = answers(neighbours.nearest(df, divisor=10, k=6).collect())
    for q in range(0, 900, 10):
        want = brute(list(range(900)), v, q, 6)
        if q % 3 == 0:
            assert found[q] == want
    assert recall(found, list(range(900)), v, range(0, 900, 10), 6) >= 0.9


def test_a_list_larger_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 8)
    v = clustered(100)  # one list
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = answers(neighbours.nearest(df, divisor=9, k=4).collect())
    assert recall(found, list(range(100)), v, range(0, 100, 9), 4) == 1


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, -0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (120, []),
        (140, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [-1.0, 0.0]), (3, [-2.0, 0.0]),
        (160, [0.0, 1.0]), (-20, [-0.0, 3.0]),
    ]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, entry int, cell int, score int")
    found = answers(neighbours.nearest(df, divisor=20, k=3).collect())
    assert found == {
        0: [(1, 2.0), (2, 2.0), (-20, 0.0)],
        160: [(-20, 3.0), (1, 1.0), (2, 1.0)],
        -20: [(1, 3.0), (2, 3.0), (160, 3.0)],
    }
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0")).count() == 0
    assert neighbours.nearest(df.where("vec_id IN (0, 1)"), k=20).collect() == [(0, 1, 1, 2.0)]


def test_walks_find_the_nearest_centroids():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 12)).astype(np.float32)
    centroids, groups = neighbours.balanced_centroids(points, 300)
    assert 200 <= len(centroids) <= 300 and (np.diff(groups) >= 0).all()
    sizes = np.bincount(neighbours.squared_distances(points, centroids).argmin(1), minlength=len(centroids))
    assert sizes.max() <= 6 * sizes.mean()
    graph = neighbours.Graph(*neighbours.linked_centroids(centroids, groups))
    ids, away = graph.near(points[:200], 20)
    d = neighbours.squared_distances(points[:200], centroids)
    want = np.argsort(d, axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(ids.tolist(), want.tolist())]) > 0.95
    assert all(len(set(row)) == 20 for row in ids.tolist()) and (np.diff(away, axis=1) >= 0).all()
    whole, _ = graph.near(points[:5], 10_000)
    assert all(sorted(row) == list(range(len(centroids))) for row in whole.tolist())
    for i, lists in enumerate(neighbours.lists_of_queries(graph, points[:50], sizes, 0)):
        near = np.sqrt(d[i])
        within = np.flatnonzero(near <= neighbours.SEARCH_RATIO * near.min())
        assert len(set(lists) & set(within)) >= 0.9 * len(within)
    for lists in neighbours.lists_of_queries(graph, points[:50], sizes, 2900):
        assert sizes[lists].sum() >= 2900
    copies = neighbours.lists_of_entries(graph, points[:200])
    assert all(1 <= len(c) <= neighbours.COPIES for c in copies) and any(len(c) > 1 for c in copies)


# ---- Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i : i + 3])) for i in range(0, len(found[-1]), 3)])
    return found


def manifest(rows):
    """Brute force over rows (source, doc_id, digest, changed): a sorted list of results."""
    order = lambda s: (s is not None, (s or "").encode())
    sources = sorted({r[0] for r in rows}, key=order)
    own = {s: sorted((r for r in rows if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for s in sources}
    trees = {s: levels_of([r[2] for r in own[s]]) for s in sources}
    upper = levels_of([trees[s][-1][0] for s in sources])
    found = []
    for at, s in enumerate(sources):
        for place, (_, doc_id, leaf, node) in enumerate(own[s]):
            proof = ""
            for nodes, k in ((trees[s], place), (upper, at)):
                for level in nodes[:-1]:
                    first = k - k % 3
                    before, after = "".join(level[first:k]), "".join(level[k + 1 : first + 3])
                    proof, node, k = proof + before + after, digest(before + node + after), k // 3
            root = upper[-1][0]
            found.append((doc_id, leaf, trees[s][-1][0], root, digest(proof), node, node == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_equal_brute_force(spark, levels):
    """Sources of 1 to 200 rows, null and empty ones, null and repeated ids, in blocks of 3, 9 and 729 leaves."""
    sizes = {None: 5, "": 1, "a": 28, "ab": 9, "Z": 10, "é": 200, "\U0001f600": 3, "z": 27}
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            doc_id = None if i == 3 else i - i % 2 if i < 8 else i
            leaf = digest(f"{source}{i}")
            rows.append((source, doc_id, leaf, digest(leaf) if i % 4 == 0 else leaf))
    df = spark.createDataFrame(rows, "source string, doc_id long, d string, c string").repartition(5)
    leaves = df.select("source", "doc_id", F.unhex("d").alias("digest"), F.unhex("c").alias("changed"))
    got = sorted((tuple(r) for r in merkle.proofs(leaves, levels).collect()), key=repr)
    assert got == manifest(rows)


def test_lone_leaf_and_no_rows(spark):
    leaf = digest("x")
    df = spark.createDataFrame([("s", 1, leaf)], "source string, doc_id long, d string")
    leaves = df.select("source", "doc_id", F.unhex("d").alias("digest"), F.unhex("d").alias("changed"))
    assert [tuple(r) for r in merkle.proofs(leaves).collect()] == [(1, leaf, leaf, leaf, digest(""), leaf, True)]
    assert merkle.proofs(leaves.limit(0)).count() == 0


def test_versions_share_untouched_nodes():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    first = merkle.tree(nodes, alone=True, levels=6)
    other = hashlib.sha256(b"other").digest()
    copied = merkle.put(first, 13, other)
    whole = merkle.tree(nodes[:13] + [other] + nodes[14:], alone=True, levels=6)
    assert [place for place, _ in copied] == [13, 4, 1, 0] and len(copied) == len(first)
    for k, (place, node) in enumerate(copied):
        assert whole[k][place] == node
        assert [n for i, n in enumerate(whole[k]) if i != place] == [n for i, n in enumerate(first[k]) if i != place]
    assert merkle.put(first, 13, nodes[13]) == [(13 // 3**k, level[13 // 3**k]) for k, level in enumerate(first)]


def test_leaf_fields(spark):
    row = spark.createDataFrame([(7, None, "é", 3, "a\nb")], "doc_id long, source string, lang string, n_chars long, text string")
    got = row.select(merkle.leaf(*[F.col(c) for c in row.columns])).first()[0]
    assert got == digest("1:7-2:é1:33:a\nb")
