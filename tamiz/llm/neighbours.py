"""Approximate nearest neighbours by largest inner product, on balanced posting lists.

Fitting: a bounded sample is clustered in two balanced steps, and a graph over
the centroids links each to near ones in different directions. Every
executor holds both; their size is bounded by ``MAX_LISTS``.

Indexing: a vector goes to the list of its nearest centroid and, near a
boundary, to further ones that lie in other directions. Searching: a query
walks the graph with a beam that widens until the farthest centroid found is
beyond ``SEARCH_RATIO`` times the nearest one; all lists within are read.
Lists that lie near each other share a cell of bounded size; a larger list has several.
Cells are joined with the queries that read any of their lists, and each sends
back its best per query.

Largest inner product becomes least distance by one more coordinate: with M the
greatest norm, x becomes (x, sqrt(M² - |x|²)) / M and a query (q, 0) / M.
Equal vectors are one entry with the least ids that can be in a result, so a vector
that a third of all rows share is one point.

Defined results: rows with a null id or a null, zero or empty vector or one with null
or non-finite components take no part, nor do those whose length is not that
of most rows (ties: the greater length). Of rows that share an id the one with
the least vector counts. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches, frozen, release_memory

#: Vectors that a list holds on average before boundary copies, lists at most, and sample vectors for each.
LIST_ROWS, MAX_LISTS, SAMPLE_PER_LIST = 256, 16_384, 8
#: A vector is copied to centroids within this ratio of its nearest one, into so many lists at most.
COPY_RATIO, COPIES = 1.1, 4
#: A query reads all lists whose centroid is within this ratio of its nearest one.
SEARCH_RATIO = 1.3
#: Numbers that the sample may hold: long vectors have fewer lists.
SAMPLE_NUMBERS = 16_000_000
#: Entries and queries of one cell.
CELL_ROWS, CELL_QUERIES = 32_768, 8_192
#: Links of a centroid; centroids expanded at a time by a walk; vectors that walk together.
LINKS, EXPANDED, TOGETHER = 24, 4, 256


# --- fitting ---------------------------------------------------------------------------


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def cluster(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and assignment of Lloyd's algorithm; an empty centroid moves to a random point."""
    centroids = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate(
            [squared_distances(points[i : i + 4096], centroids).argmin(1) for i in range(0, len(points), 4096)]
        )
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=k)
        moved = points[rng.choice(len(points), k)]
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], moved)
    return centroids, nearest


def balanced_centroids(points: np.ndarray, lists: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """About ``lists`` centroids of about equally many points, and the first-step group of each, in order.

    Points are parted into sqrt(lists) groups; each group gets lists in proportion to its size.
    """
    rng = np.random.default_rng(seed)
    _, group = cluster(points, max(1, min(len(points), round(lists**0.5))), rng)
    centroids, groups = [], []
    for g in np.unique(group):
        own = points[group == g]
        k = min(len(own), max(1, round(lists * len(own) / len(points))))
        found, nearest = cluster(own, k, rng)
        found = found[np.unique(nearest)]
        centroids.append(found)
        groups.append(np.full(len(found), g))
    return np.concatenate(centroids).astype(np.float32), np.concatenate(groups)


class Graph:
    """Centroids, their links (-1: none) and where walks start; ``near`` walks for many vectors together."""

    def __init__(self, centroids: np.ndarray, links: np.ndarray, starts: np.ndarray):
        self.centroids, self.links, self.starts = centroids, links, starts
        self.norms = (centroids * centroids).sum(1)

    def near(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Per vector the ``width`` nearest centroids found and their distances, nearest first.

        Best first: the nearest centroids not yet expanded give their links,
        until none of the ``width`` best is left to expand.
        """
        width = min(width, len(self.centroids))
        found = [self._walk(vectors[i : i + TOGETHER], width) for i in range(0, len(vectors), TOGETHER)]
        ids = np.concatenate([f[0] for f in found]) if found else np.zeros((0, width), np.int32)
        return ids, np.concatenate([f[1] for f in found]) if found else np.zeros((0, width), np.float32)

    def _walk(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        b, rows = len(vectors), np.arange(len(vectors))[:, None]
        own = (vectors * vectors).sum(1)[:, None]
        seen = np.zeros((b, len(self.centroids) + 1), bool)  # the last column takes absent links
        seen[:, self.starts] = seen[:, -1] = True
        ids = np.broadcast_to(self.starts.astype(np.int32), (b, len(self.starts)))
        away = squared_distances(vectors, self.centroids[self.starts])
        done = np.zeros(ids.shape, bool)
        while True:
            keep = np.argsort(away, axis=1, kind="stable")[:, :width]
            ids, away, done = ids[rows, keep], away[rows, keep], done[rows, keep]
            open_ = ~done & np.isfinite(away)
            first = np.argsort(~open_, axis=1, kind="stable")[:, :EXPANDED]  # nearest open ones
            active = open_[rows, first]
            if not active.any():
                break
            done[rows, first] = True
            linked = np.where(active[:, :, None], self.links[ids[rows, first]], -1).reshape(b, -1)
            new = ~seen[rows, linked]
            seen[rows, linked] = True
            d = own + self.norms[linked] - 2 * np.einsum("brd,bd->br", self.centroids[linked], vectors)
            # One centroid may be linked twice in a step: all but its first place are left out.
            order = np.argsort(linked, axis=1, kind="stable")
            ranked = np.take_along_axis(linked, order, 1)
            twice = np.zeros_like(new)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            d = np.where(new & ~twice, np.maximum(d, 0), np.inf)
            ids, away = np.concatenate([ids, linked], 1), np.concatenate([away, d], 1)
            done = np.concatenate([done, np.zeros(d.shape, bool)], 1)
        if ids.shape[1] < width:
            short = width - ids.shape[1]
            ids = np.pad(ids, [(0, 0), (0, short)], constant_values=-1)
            away = np.pad(away, [(0, 0), (0, short)], constant_values=np.inf)
        return ids, np.sqrt(away)


def spread_out(order: list[int], away, centroids: np.ndarray, most: int) -> list[int]:
    """Of candidates, nearest first, those that are not nearer to one already chosen."""
    chosen: list[int] = []
    for j in order:
        if len(chosen) == most:
            break
        if not chosen or away[j] <= ((centroids[chosen] - centroids[j]) ** 2).sum(1).min():
            chosen.append(int(j))
    return chosen


def linked_centroids(centroids: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of a ``Graph``. Every centroid can be reached: walks start at the
    first of each group, and the members of a group are chained."""
    n = len(centroids)
    links = np.full((n, LINKS + 1), -1, np.int32)
    for first in range(0, n, 512):
        d = squared_distances(centroids[first : first + 512], centroids)
        order = np.argsort(d, axis=1, kind="stable")[:, : 3 * LINKS + 1]
        for row, i in enumerate(range(first, min(first + 512, n))):
            chosen = spread_out([j for j in order[row] if j != i], d[row], centroids, LINKS)
            links[i, : len(chosen)] = chosen
    same = np.flatnonzero(groups[1:] == groups[:-1])
    links[same, LINKS] = same + 1
    return centroids, links, np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])


def lists_of_entries(graph: Graph, points: np.ndarray) -> list[np.ndarray]:
    """Per vector its nearest list and, near boundaries, up to ``COPIES - 1`` more in other directions."""
    ids, away = graph.near(points, 32)
    found = []
    for row, d in zip(ids, away):
        near = [int(j) for j, x in zip(row, d) if np.isfinite(x) and x <= COPY_RATIO * d[0]] or [int(row[0])]
        if len(near) > 1:
            squared = dict(zip(row.tolist(), (d * d).tolist()))
            near = spread_out(near, squared, graph.centroids, COPIES)
        found.append(np.array(near, np.int32))
    return found


def lists_of_queries(graph: Graph, points: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """Per query all lists within ``SEARCH_RATIO``, and the next ones until they hold ``least`` rows.

    The beam doubles until it reaches beyond them.
    """
    found: list = [None] * len(points)
    left, width = np.arange(len(points)), 64
    while len(left):
        ids, away = graph.near(points[left], width)
        held = np.where(ids >= 0, sizes[ids], 0)
        short = np.cumsum(held, axis=1) - held < least
        within = np.isfinite(away) & ((away <= SEARCH_RATIO * away[:, :1]) | short)
        whole = ~within[:, -1] | (ids.shape[1] == len(graph.centroids))
        for i in np.flatnonzero(whole):
            found[left[i]] = ids[i][within[i]]
        left, width = left[~whole], width * 2
    return found


# --- rows ------------------------------------------------------------------------------


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v array<double>): the rows that take part, one for each id."""
    # Adding 0 leaves one zero, which has no sign.
    v = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
        " AND exists(v, x -> x <> 0)"
    )
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if usual is not None:
        rows = rows.where(F.size("v") == usual["length"])
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """(entry, ids, v, norm2): one row per different vector; ``ids`` are its ``k + 1`` least ids, ``entry`` the first.

    A task forwards at most k + 1 rows of a vector.
    """
    same = Window.partitionBy("h", "v").orderBy("vec_id")  # sorts by the hash first
    least = rows.withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    merged = least.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return merged.select(F.col("ids")[0].alias("entry"), "ids", "v", norm2.alias("norm2"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def augmented(v: np.ndarray, greatest: float) -> np.ndarray:
    """Entries with the coordinate that makes all of them equally long, scaled to length 1."""
    scaled = v / greatest
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(1), 0))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


def asked(v: np.ndarray, greatest: float) -> np.ndarray:
    return np.concatenate([v / greatest, np.zeros((len(v), 1))], axis=1).astype(np.float32)


def fit(entries: DataFrame, n: int, length: int, greatest: float, seed: int = 7) -> tuple[np.ndarray, ...]:
    """The parts of a graph of centroids, from a sample of the ``n`` entries by a seeded hash.

    At most ``MAX_LISTS`` lists, ``SAMPLE_PER_LIST`` vectors for each and ``SAMPLE_NUMBERS`` numbers.
    """
    lists = max(1, min(MAX_LISTS, n // LIST_ROWS, SAMPLE_NUMBERS // (SAMPLE_PER_LIST * length)))
    bound = lists * SAMPLE_PER_LIST
    share = 1.1 * bound / n + 1e-4  # of hash values: some more than are taken
    h = F.xxhash64(F.lit(seed), "entry").alias("h")
    drawn = entries.select(h, "entry", "v").where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)
    sample = drawn.orderBy("h", "entry").limit(max(bound, LIST_ROWS)).select("v").toArrow()
    points = augmented(matrix(sample.column("v").combine_chunks()), greatest)
    return linked_centroids(*balanced_centroids(points, lists, seed))


def with_lists(df: DataFrame, parts_of_graph: tuple, place) -> DataFrame:
    """Adds ``lists``: those that ``place`` of (graph, vectors) gives each row."""
    shared = df.sparkSession.sparkContext.broadcast(parts_of_graph)

    def add(batches):
        graph = Graph(*shared.value)
        for batch in batches:
            v = matrix(batch.column("v"))
            if not len(v):
                continue
            listed = pa.array([f.tolist() for f in place(graph, v)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, "lists"])
        release_memory()

    return df.mapInArrow(add, df.withColumn("lists", F.array().cast("array<int>")).schema)


def cells(held: list[int]) -> tuple[list[int], list[int]]:
    """Per list its cell, and per cell over how many parts it is dealt, from the entries in each list.

    Neighbouring lists (they are numbered by group) share a cell of up to ``CELL_ROWS`` entries.
    """
    cell_of, full = [], []
    for n in held:
        if not full or full[-1] + n > CELL_ROWS:
            full.append(0)
        full[-1] += n
        cell_of.append(len(full) - 1)
    return cell_of, [max(1, -(-n // CELL_ROWS)) for n in full]


def in_cells(df: DataFrame, cell_of: list[int], parts: list[int], crowds: list[int], queries: bool) -> DataFrame:
    """(entry, v, lists, cell, part, crowd): a row for each cell with the lists that it has there.

    A cell's entries are dealt over its parts and its queries over its crowds;
    every part meets every crowd. Entries of cells that nobody reads are left out.
    """
    names = ["entry", "v", "lists", "cell", "part", "crowd"]
    own, other = (crowds, parts) if queries else (parts, crowds)

    def deal(batches):
        cells_, own_, other_ = (np.array(x, np.int64) for x in (cell_of, own, other))
        for batch in batches:
            lists = batch.column("lists")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            number = lists.flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((number, cells_[number], row))
            row, number = row[order], number[order]
            place, first = np.unique(row * len(own_) + cells_[number], return_index=True)
            row, cell = place // len(own_), place % len(own_)
            held = pa.ListArray.from_arrays(pa.array(np.r_[first, len(number)], pa.int32()), pa.array(number, pa.int32()))
            copies = np.repeat(np.arange(len(place)), other_[cell])
            number_of_copy = np.arange(len(copies)) - np.repeat(np.cumsum(other_[cell]) - other_[cell], other_[cell])
            row, cell = row[copies], cell[copies]
            entry = batch.column("entry").to_numpy()[row]
            mine = (entry.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            mine %= np.maximum(own_[cell], 1)
            part, crowd = (number_of_copy, mine) if queries else (mine, number_of_copy)
            for at in range(0, len(row), 4096):
                some = slice(at, at + 4096)
                columns = [entry[some], batch.column("v").take(pa.array(row[some])), held.take(pa.array(copies[some]))]
                columns += [x[some].astype(np.int32) for x in (cell, part, crowd)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = "entry long, v array<double>, lists array<int>, cell int, part int, crowd int"
    return df.select("entry", "v", "lists").mapInArrow(deal, schema)


def best_of_cell(k: int):
    """Function of a cell's queries and entries: (asking, entry, score), the best ``k + 1`` entries of each query."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, entries = left.combine_chunks(), right.combine_chunks()
        out: dict[str, list] = {"asking": [], "entry": [], "score": []}
        if queries.num_rows and entries.num_rows:
            v, q = matrix(entries["v"].chunk(0)), matrix(queries["v"].chunk(0))
            entry, asking = entries["entry"].to_numpy(), queries["entry"].to_numpy()
            members = _by_list(entries["lists"].chunk(0))
            readers = _by_list(queries["lists"].chunk(0))
            for first in range(0, len(q), 128):
                part = q[first : first + 128]
                scores = np.full((len(part), len(v)), -np.inf)
                for number, who in readers.items():
                    own = members.get(number)
                    who = who[(who >= first) & (who < first + 128)] - first
                    if own is not None and len(who):
                        scores[np.ix_(who, own)] = part[who] @ v[own].T
                for i, row in enumerate(scores):
                    reached = np.flatnonzero(row > -np.inf)
                    if not len(reached):
                        continue
                    if len(reached) > k + 1:
                        least = np.partition(row[reached], -(k + 1))[-(k + 1)]
                        # Sums in another order may differ in their last bits.
                        slack = 1e-9 * (1 + abs(least))
                        reached = reached[row[reached] >= least - slack]
                    exact = np.cumsum(v[reached] * part[i], axis=1)[:, -1]
                    order = np.lexsort((entry[reached], -exact))[: k + 1]
                    out["asking"].append(np.full(len(order), asking[first + i]))
                    out["entry"].append(entry[reached][order])
                    out["score"].append(exact[order])
        types = {"asking": np.int64, "entry": np.int64, "score": np.float64}
        columns = {c: np.concatenate(x) if x else np.zeros(0, types[c]) for c, x in out.items()}
        release_memory()
        return pa.table(columns)

    return search


def _by_list(lists: pa.Array) -> dict[int, np.ndarray]:
    """Rows of each list number."""
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    numbers = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(numbers, kind="stable")
    found, starts = np.unique(numbers[order], return_index=True)
    return dict(zip(found.tolist(), np.split(rows[order], starts[1:])))


def nearest(
    df: DataFrame, divisor: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 7
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for every row whose id ``divisor`` divides.

    Candidates are all rows but the query's own; ties go to the smaller id.
    The score is the sum, in order of the components, of the products in double precision.
    """
    bounded_batches(df)
    rows = frozen(valid_vectors(df, vec_id, vector), "neighbours-rows")
    entries = frozen(entries_of(rows, k), "neighbours-entries")
    n, norm2, length = entries.agg(F.count("*"), F.max("norm2"), F.max(F.size("v"))).first()
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    greatest = float(norm2) ** 0.5
    graph = fit(entries, n, length, greatest, seed)

    stored = with_lists(entries.select("entry", "v"), graph, lambda g, v: lists_of_entries(g, augmented(v, greatest)))
    stored = frozen(stored, "neighbours-lists")
    # One number per list or cell reaches the driver.
    counted = stored.select(F.explode("lists").alias("list")).groupBy("list").count().collect()
    held = np.zeros(len(graph[0]), np.int64)
    for r in counted:
        held[r["list"]] = r["count"]
    cell_of, parts = cells(held.tolist())

    asking = rows.where(F.col("vec_id") % divisor == 0).select(F.col("vec_id").alias("query_id"), "v")
    # Queries with one vector are searched for once, under the least id among them.
    vectors = asking.groupBy("v").agg(F.min("query_id").alias("entry")).select("entry", "v")
    least = COPIES * (k + 1)  # rows among which k + 1 entries differ
    wanted = with_lists(vectors, graph, lambda g, v: lists_of_queries(g, asked(v, greatest), held, least))
    wanted = frozen(wanted, "neighbours-queries")

    number = df.sparkSession.createDataFrame(list(enumerate(cell_of)), "list int, cell int")
    readers = wanted.select("entry", F.explode("lists").alias("list")).join(F.broadcast(number), "list")
    readers = readers.select("entry", "cell").distinct().groupBy("cell").count()
    crowds = [0] * len(parts)
    for r in readers.collect():
        crowds[r["cell"]] = -(-r["count"] // CELL_QUERIES)

    left, right = (in_cells(side, cell_of, parts, crowds, side is wanted) for side in (wanted, stored))
    key = ["cell", "part", "crowd"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        best_of_cell(k), "asking long, entry long, score double"
    )
    # The same entry comes from several lists with the same score.
    ranked = found.groupBy("asking", "entry").agg(F.max("score").alias("score")).withColumn(
        "n", F.row_number().over(Window.partitionBy("asking").orderBy(F.desc("score"), "entry"))
    )
    best = ranked.where(F.col("n") <= k + 1).join(entries.select("entry", "ids"), "entry")
    best = best.select("asking", "score", F.explode("ids").alias("vec_id")).groupBy("asking").agg(
        F.slice(
            F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k + 1
        ).alias("best")
    )
    named = asking.join(wanted.select(F.col("entry").alias("asking"), "v"), "v").select("query_id", "asking")
    answers = named.join(best, "asking").select(
        "query_id",
        F.posexplode(F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("at", "x"),
    )
    return answers.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score")
    )
