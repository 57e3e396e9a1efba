"""Repeated passages found with enhanced suffix arrays and removed, first occurrence kept.

A passage counts if ``SPAN`` bytes or more of it occur elsewhere. Suffixes are
sampled where every such passage must have one: among the hashes of the
``GRAM`` bytes at each place, the least of any window that spans ``SPAN`` bytes
marks an anchor, so two copies of a passage have an anchor at the same place.

1. Documents are dealt into memory-sized buckets; each sends the distinct
   hashes of its anchors to hash buckets, which answer with those that occur
   more than once.
2. Each bucket sends the surroundings of these anchors, once per distinct
   content, to the hash buckets.
3. There the suffixes that start at anchors are sorted: a suffix array with
   common prefix lengths. A stack scan yields its common-prefix intervals; the
   members of each are sorted by what precedes them and scanned likewise. An
   interval of both is a group whose members agree no further to the right and
   whose bytes to the left differ: a maximal repeat with all its occurrences.
   All but the first are sent back as removed.
4. Each bucket unites what it was sent and cuts its documents.

Copies within a bucket are reduced to one before anything is sent, so a group
of copies, however large, sends one surrounding per bucket. An anchor that more
than ``HOT`` places share sends every 100-byte string around it on its own
instead: those that are equal merge, the others part, and no task gets them all.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches, bucket_count, frozen, lean, lean_pair, text_bytes

SPAN = 100
GRAM = 32
WINDOW = SPAN - GRAM + 1
BEFORE = SPAN - GRAM
CONTEXT = SPAN + BEFORE
HOT = 100_000
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
CHUNK = 1 << 19
#: Surroundings compared at once.
PART = 1 << 15
#: Hash buckets for each bucket of documents; they hold expanded surroundings, so they are smaller.
FINER = 2
U64 = np.uint64


# ---- within one bucket of documents -------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> U64(32)
    h *= U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every place, by doubling."""
    if len(data) < GRAM:
        return np.zeros(0, U64)
    h = _mixed(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))[data]
    power, size = 0x100000001B3, 1
    while size < GRAM:
        h = h[:-size] * U64(power) + h[size:]
        power, size = power * power % (1 << 64), 2 * size
    return _mixed(h)


def _sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h, size = pick(h[:-size], h[size:]), 2 * size
    return pick(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: the least hashes of all windows of ``WINDOW`` places."""
    places, hashes = [], []
    for at in range(0, max(1, len(data)), CHUNK):
        begin = max(0, at - WINDOW)  # windows that end in this chunk
        h = gram_hashes(data[begin : at + CHUNK + SPAN])
        if len(h) < WINDOW:
            continue
        least = _sliding(h, WINDOW, np.minimum)
        edge = np.zeros(WINDOW - 1, U64)
        greatest = _sliding(np.concatenate((edge, least, edge)), WINDOW, np.maximum)
        found = np.flatnonzero(greatest == h)
        found = found[(found >= at - begin) & (found < at - begin + CHUNK)]
        places.append(found + begin)
        hashes.append(h[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(places), np.concatenate(hashes)


def up_to(place: np.ndarray, before: int) -> np.ndarray:
    """Each number of the ranges [place - before, place] once, ascending; ``place`` ascends, none below 0."""
    begin = np.maximum(place - before, np.concatenate(([0], place[:-1] + 1)))
    count = place - begin + 1
    return np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)


class Bucket:
    """The texts of a bucket one after another, in the order (doc_id, row); null ids come last."""

    def __init__(self, table: pa.Table):
        ids = table.column("order").combine_chunks()
        rank = np.asarray(ids.fill_null(np.iinfo(np.int64).max))
        self.order = np.lexsort((table.column("row").to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), rank))
        self.ids = rank[self.order]
        self.rows = table.column("row").to_numpy()[self.order]
        texts = table.column("text").cast(pa.binary()).to_pylist()
        texts = [texts[i] or b"" for i in self.order]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Those that lie within a document of at least ``SPAN`` bytes."""
        place, value = anchors(self.data)
        doc = self.doc(place)
        end = self.starts[doc + 1]
        inside = (place + GRAM <= end) & (end - self.starts[doc] >= SPAN)
        return place[inside], value[inside]

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1

    def contexts(self, place: np.ndarray, before: np.ndarray) -> np.ndarray:
        """For each place ``SPAN`` bytes from it on, then those before it, nearest first, at most ``before``.

        Bytes are shifted by one: 0 stands for what lies outside the document.
        """
        doc = self.doc(place)
        right, left = self.starts[doc + 1] - place, np.minimum(place - self.starts[doc], before)
        steps = np.concatenate((np.arange(SPAN), -1 - np.arange(BEFORE)))
        out = np.empty((len(place), CONTEXT), np.uint8)
        for k in range(0, len(place), 1 << 13):
            part = slice(k, k + (1 << 13))
            at = place[part, None] + steps
            there = np.concatenate(
                (steps[:SPAN] < right[part, None], -1 - steps[SPAN:] < left[part, None]), axis=1
            )
            out[part] = np.where(there, self.data[np.clip(at, 0, len(self.data) - 1)] + 1, 0)
        return out


def reach(contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes present before and from the place on."""
    return (contexts[:, SPAN:] != 0).sum(axis=1), (contexts[:, :SPAN] != 0).sum(axis=1)


def merged(place: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places and distinct contexts of at least ``SPAN`` bytes, and the spans of the other places."""
    left, right = reach(contexts)
    enough = left + right >= SPAN
    place, contexts, left, right = place[enough], contexts[enough], left[enough], right[enough]
    text = contexts.view(f"S{CONTEXT}").ravel()
    by_text = np.lexsort((place, text))
    new = np.ones(len(place), bool)
    new[1:] = text[by_text][1:] != text[by_text][:-1]
    first, again = by_text[new], by_text[~new]
    return place[first], contexts[first], np.stack((place[again] - left[again], place[again] + right[again]))


def packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpacked(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob)


def dealt(target: np.ndarray, buckets: int):
    """(bucket, indices) for each bucket that occurs in ``target``."""
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order])) + 1
    return [(int(target[g[0]]), g) for g in np.split(order, cuts) if len(g)] if len(order) else []


HASHES = "b long, p long, blob binary"


def send_hashes(table: pa.Table, buckets: int) -> pa.Table:
    p = table.column("p")[0].as_py()
    _, value = Bucket(table).anchors()
    value, count = np.unique(value, return_counts=True)
    out = [
        (b, p, packed(value[g], count[g].astype(np.uint32))) for b, g in dealt((value % U64(buckets)).astype(np.int64), buckets)
    ]
    return _rows(out, ("b", "p", "blob"), (pa.int64(), pa.int64(), pa.binary()))


def _rows(rows: list[tuple], names: tuple, types: tuple) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


REPEATED = "p long, blob binary"


def find_repeated(table: pa.Table, hot: int) -> pa.Table:
    """For every document bucket the hashes that occur more than once, with a mark on those past ``hot``."""
    parts = [unpacked(x) for x in table.column("blob").to_pylist()]
    sizes = [len(x) // 12 for x in parts]
    value = np.concatenate([np.frombuffer(x, U64, n) for x, n in zip(parts, sizes)])
    count = np.concatenate([np.frombuffer(x, np.uint32, n, 8 * n) for x, n in zip(parts, sizes)])
    _, inverse = np.unique(value, return_inverse=True)
    total = np.bincount(inverse, count)[inverse]
    out, at = [], 0
    for p, n in zip(table.column("p").to_pylist(), sizes):
        own = np.flatnonzero(total[at : at + n] > 1) + at
        if len(own):
            out.append((p, packed(value[own], (total[own] > hot).astype(np.uint8))))
        at += n
    return _rows(out, ("p", "blob"), (pa.int64(), pa.binary()))


ENTRIES = "b long, p long, kind int, blob binary"
FIELDS = ("ids", "rows", "within", "place")


def send_contexts(docs: pa.Table, repeated: pa.Table, buckets: int) -> pa.Table:
    """Distinct surroundings of repeated anchors (kind 0), and spans that repeat within the bucket (kind 1)."""
    names, types = ("b", "p", "kind", "blob"), (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    if not docs.num_rows or not repeated.num_rows:
        return _rows([], names, types)
    p, bucket = docs.column("p")[0].as_py(), Bucket(docs)
    parts = [unpacked(x) for x in repeated.column("blob").to_pylist()]
    known = np.concatenate([np.frombuffer(x, U64, len(x) // 9) for x in parts])
    hot = np.concatenate([np.frombuffer(x, np.uint8, len(x) // 9, len(x) // 9 * 8) for x in parts])
    order = np.argsort(known)
    known, hot = known[order], hot[order]
    place, value = bucket.anchors()
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    in_set = known[at] == value
    place, value, crowded = place[in_set], value[in_set], hot[at[in_set]] == 1
    before = np.where(crowded, 0, BEFORE)
    if crowded.any():  # each string of SPAN bytes around a crowded anchor stands for itself
        around = up_to(place[crowded], BEFORE)
        doc = bucket.doc(around)
        around = around[around + SPAN <= bucket.starts[doc + 1]]
        far = gram_hashes(bucket.data)
        strings = far[around] * U64(3) + far[around + GRAM] * U64(5) + far[around + 2 * GRAM] * U64(7) + far[around + BEFORE]
        place = np.concatenate((place[~crowded], around))
        value = np.concatenate((value[~crowded], _mixed(strings)))
        before = np.concatenate((before[~crowded], np.zeros(len(around), np.int64)))
    rows, spans = [], []
    for target, g in dealt((value % U64(buckets)).astype(np.int64), buckets):
        parts = []
        for k in range(0, len(g), PART):  # equal ones merge part by part, so a run of one byte stays small
            part = g[k : k + PART]
            *kept, again = merged(place[part], bucket.contexts(place[part], before[part]))
            parts.append(kept)
            spans.append(again)
        own, contexts = map(np.concatenate, zip(*parts)) if len(parts) > 1 else parts[0]
        if len(parts) > 1:
            own, contexts, again = merged(own, contexts)
            spans.append(again)
        if not len(own):
            continue
        doc = bucket.doc(own)
        fields = (bucket.ids[doc], bucket.rows[doc], own - bucket.starts[doc], own)
        rows.append((target, p, 0, packed(*fields, contexts)))
    spans = np.concatenate(spans, axis=1) if spans else np.zeros((2, 0), np.int64)
    if spans.size:
        rows.append((p, p, 1, packed(spans)))
    return _rows(rows, names, types)


# ---- the enhanced suffix array of one hash bucket -----------------------------------------------


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row; absent bytes (0) agree with nothing."""
    differs = (a != b) | (a == 0)
    n = differs.argmax(axis=1)
    n[~differs.any(axis=1)] = a.shape[1]
    return n


def prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two equally long byte strings, absent bytes agreeing with nothing."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    n = len(a) - (x.bit_length() + 7) // 8
    absent = a.find(0, 0, n)
    return n if absent < 0 else absent


def intervals(common: list[int]):
    """Common-prefix intervals (length, first, last) by a stack scan.

    ``common[i]`` is the common prefix of entries i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate(itertools.chain(common, (-1,))):
        first = i
        while stack and stack[-1][0] > length:
            depth, first = stack.pop()
            yield depth, first, i
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def maximal_repeats(rights: list[bytes], lefts: list[bytes], common: list[int]):
    """(bytes before, bytes from the place on, members) of all maximal repeats of at least ``SPAN`` bytes.

    ``rights`` are sorted, distinct entries' bytes from their place on,
    ``lefts`` the bytes before it, nearest first; ``common`` as in
    ``intervals``. Members of a group share all bytes named, neither all go on
    alike to the right nor to the left, as far as the bytes reach.
    """
    for depth, first, last in intervals(common):
        need = SPAN - depth
        if need > BEFORE:
            continue
        members = sorted(range(first, last + 1), key=lefts.__getitem__)
        shared = [prefix(lefts[a], lefts[b]) for a, b in itertools.pairwise(members)]
        begin = 0
        for cut in [i for i, n in enumerate(shared) if n < need] + [len(shared)]:
            if cut > begin:
                for before, x, y in intervals(shared[begin:cut]):
                    group = members[begin + x : begin + y + 1]
                    if prefix(rights[min(group)], rights[max(group)]) == depth:  # else a deeper interval has it
                        yield before, depth, group
            begin = cut + 1


def longest_spans(run: np.ndarray, common: list[int], ages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, bytes before, bytes ahead) of what the maximal repeats of a run remove, without what others cover."""
    rights = [r.tobytes() for r in run[:, :SPAN]]
    lefts = [r.tobytes() for r in run[:, SPAN:]]
    best = np.zeros((len(run), BEFORE + 1), np.uint8)  # bytes ahead, by bytes before
    for back, ahead, group in maximal_repeats(rights, lefts, common):
        group = np.array(group)
        later = np.delete(group, ages[group].argmin())
        best[later, back] = np.maximum(best[later, back], ahead)
    beyond = np.maximum.accumulate(best[:, :0:-1], axis=1)[:, ::-1]  # the most with more bytes before
    best[:, :-1][best[:, :-1] <= beyond] = 0
    member, back = np.nonzero(best)
    return member, back, best[member, back].astype(np.int64)


SPANS = "p long, blob binary"


def scan_suffixes(table: pa.Table) -> pa.Table:
    """Removed spans for each document bucket, from the entries of one hash bucket."""
    names, types = ("p", "blob"), (pa.int64(), pa.binary())
    kinds, owners, blobs = (table.column(c).to_pylist() for c in ("kind", "p", "blob"))
    out = [(p, blob) for kind, p, blob in zip(kinds, owners, blobs) if kind == 1]
    parts = [(p, unpacked(blob)) for kind, p, blob in zip(kinds, owners, blobs) if kind == 0]
    if not parts:
        return _rows(out, names, types)
    size = 8 * len(FIELDS) + CONTEXT
    counts = [len(x) // size for _, x in parts]
    ids, rows, within, place = (
        np.concatenate([np.frombuffer(x, np.int64, n, 8 * n * f) for (_, x), n in zip(parts, counts)])
        for f in range(len(FIELDS))
    )
    contexts = np.concatenate(
        [np.frombuffer(x, np.uint8, n * CONTEXT, 8 * n * len(FIELDS)) for (_, x), n in zip(parts, counts)]
    ).reshape(-1, CONTEXT)
    owner = np.repeat([p for p, _ in parts], counts)
    del parts
    age = np.empty(len(ids), np.int64)
    age[np.lexsort((within, rows, ids))] = np.arange(len(ids))

    order = np.lexsort((age, contexts.view(f"S{CONTEXT}").ravel()))  # the suffix array; equal ones by age
    contexts = contexts[order]
    new = np.concatenate(([True], (contexts[1:] != contexts[:-1]).any(axis=1)))
    left, right = reach(contexts)
    again = np.flatnonzero(~new)  # equal throughout to an earlier one: repeated as far as it reaches
    found = [(order[again], left[again], right[again])]

    kept = np.flatnonzero(new)
    contexts, entry = contexts[kept], order[kept]
    common = agreement(contexts[:-1, :SPAN], contexts[1:, :SPAN])
    before = agreement(contexts[:-1, SPAN:], contexts[1:, SPAN:])
    ends = np.concatenate((np.flatnonzero(common < GRAM), [len(kept) - 1]))  # last entries of runs
    begins = np.concatenate(([0], ends[:-1] + 1))
    pairs = begins[ends - begins == 1]  # an interval of two members has no others within it
    pairs = pairs[common[pairs] + before[pairs] >= SPAN]
    later = np.where(age[entry[pairs]] > age[entry[pairs + 1]], pairs, pairs + 1)
    found.append((entry[later], before[pairs], common[pairs]))
    for a, b in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist()):
        member, back, ahead = longest_spans(contexts[a : b + 1], common[a:b].tolist(), age[entry[a : b + 1]])
        found.append((entry[a : b + 1][member], back, ahead))
    which, back, ahead = (np.concatenate(x) for x in zip(*found))
    for p, g in dealt(owner[which], 0):
        at = place[which[g]]
        spans = np.unique(np.stack((at - back[g], at + ahead[g])), axis=1)
        out.append((p, packed(spans)))
    return _rows(out, names, types)


# ---- cutting ------------------------------------------------------------------------------------


def cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """Each document without the united spans: record, kept, n_bytes, n_removed, removed."""
    bucket = Bucket(docs)
    n = len(bucket.data)
    steps = np.zeros(n + 1, np.int32)
    for blob in spans.column("blob").to_pylist():
        both = np.frombuffer(unpacked(blob), np.int64).reshape(2, -1)
        np.add.at(steps, both[0], 1)
        np.add.at(steps, both[1], -1)
    np.cumsum(steps, out=steps)
    gone = steps[:-1] > 0
    del steps
    edges = np.concatenate(([False], gone, [False]))
    at = np.flatnonzero(edges[1:] != edges[:-1])
    begins, ends = at[::2], at[1::2]
    kept, removed = [], []
    for a, b in itertools.pairwise(bucket.starts.tolist()):
        x, y = np.searchsorted(ends, a, side="right"), np.searchsorted(begins, b, side="left")
        if x >= y:
            kept.append(bucket.data[a:b].tobytes())
            removed.append([])
            continue
        kept.append(bucket.data[a:b][~gone[a:b]].tobytes())
        removed.append([{"start": max(s, a) - a, "end": min(e, b) - a} for s, e in zip(begins[x:y].tolist(), ends[x:y].tolist())])
    sizes = np.diff(bucket.starts)
    return pa.table(
        {
            "record": docs.column("record").combine_chunks().take(pa.array(bucket.order)),
            "kept": pa.array(kept, pa.binary()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        }
    )


def cut_text(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """As ``cut``, with the kept bytes as text; characters that a cut splits are dropped."""
    done = cut(docs, spans)
    kept = pa.array([x.decode("utf-8", "ignore") for x in done.column("kept").to_pylist()], pa.string())
    return done.set_column(done.column_names.index("kept"), "kept", kept)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT, as_text: bool = False
) -> DataFrame:
    """(record, kept, n_bytes, removed): every row of ``docs`` without passages that occur earlier.

    ``record`` holds the other columns as a struct, ``kept`` the remaining
    bytes (a character may be cut) or, ``as_text``, what they hold of whole
    characters, ``removed`` the maximal removed runs as (start, end) in bytes. A byte goes if it lies in a string of 100 bytes of
    its text that also starts earlier: in a row with a smaller doc_id, or
    earlier in the same text; overlaps count. Rows of one doc_id follow the
    order of the table, null ids come last. Null texts are empty; texts below
    100 bytes stay whole; an empty table stays empty.

    The texts are shuffled once; the three passes over them read that shuffle.
    """
    bounded_batches(docs)
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    buckets = bucket_count(text_bytes(docs, text), BUCKET_BYTES, LEAST_BUCKETS)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("order"),
        F.col(f"`{text}`").alias("text"),
        record.alias("record"),
    )
    rows = rows.withColumn("p", F.pmod(F.xxhash64("row"), F.lit(buckets))).repartition(buckets, "p")
    hashes = rows.groupBy("p").applyInArrow(lean(lambda t: send_hashes(t, FINER * buckets)), HASHES)
    repeated = hashes.groupBy("b").applyInArrow(lean(lambda t: find_repeated(t, hot)), REPEATED)
    repeated = repeated.repartition(buckets, "p")
    entries = rows.groupBy("p").cogroup(repeated.groupBy("p")).applyInArrow(
        lean_pair(lambda d, r: send_contexts(d, r, FINER * buckets)), ENTRIES
    )
    spans = entries.groupBy("b").applyInArrow(lean(scan_suffixes), SPANS).repartition(buckets, "p")
    kind = rows.schema["record"].dataType.simpleString()
    result = f"record {kind}, kept {'string' if as_text else 'binary'}, n_bytes long, removed array<struct<start:bigint,end:bigint>>"
    return rows.groupBy("p").cogroup(spans.groupBy("p")).applyInArrow(lean_pair(cut_text if as_text else cut), result)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with shortened texts and the same columns and rows.

    Characters that a cut splits are dropped. Null texts become empty.
    """
    done = remove_repeats(docs, doc_id, text, as_text=True)
    columns = [F.col("kept").alias(c) if c == text else F.col(f"record.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns)


# ---- groups as an output ------------------------------------------------------------------------


def own_anchors(bucket: Bucket) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of each document by itself, whatever lies beside it."""
    places, values = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for a, b in itertools.pairwise(bucket.starts.tolist()):
        if b - a >= SPAN:
            place, value = anchors(bucket.data[a:b])
            inside = place + GRAM <= b - a
            places.append(place[inside] + a)
            values.append(value[inside])
    return np.concatenate(places), np.concatenate(values)


ANCHORS = "value long, p long, n long"


def list_anchors(table: pa.Table) -> pa.Table:
    """The distinct hashes of a bucket's anchors and how often each occurs, as plain rows."""
    _, value = own_anchors(Bucket(table))
    value, count = np.unique(value, return_counts=True)
    p = np.full(len(value), table.column("p")[0].as_py())
    return pa.table({"value": value.view(np.int64), "p": p, "n": count})


PLACES = "value long, digest binary, order long, row long, start long, context binary"


def list_places(docs: pa.Table, repeated: pa.Table) -> pa.Table:
    """The places of repeated anchors with a digest of their surroundings, which come with the first of equal ones."""
    types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ("value", "digest", "order", "row", "start", "context")
    if not docs.num_rows or not repeated.num_rows:
        return _rows([], names, types)
    bucket = Bucket(docs)
    place, value = own_anchors(bucket)
    known = np.isin(value, repeated.column("value").to_numpy().view(U64))
    place, value = place[known], value[known]
    parts, seen = [], set()
    for k in range(0, len(place), PART):
        at, own = place[k : k + PART], value[k : k + PART]
        contexts = bucket.contexts(at, np.full(len(at), BEFORE))
        doc = bucket.doc(at)
        left, right = reach(contexts)
        for i in np.flatnonzero(left + right >= SPAN).tolist():
            context = contexts[i].tobytes()
            digest = hashlib.md5(context).digest()
            parts.append(
                (
                    int(own[i].view(np.int64)), digest, int(bucket.ids[doc[i]]), int(bucket.rows[doc[i]]),
                    int(at[i] - bucket.starts[doc[i]]), None if digest in seen else context,
                )
            )
            seen.add(digest)
    return _rows(parts, names, types)


GROUPS = "group string, length int, back int, digest binary"


def list_groups(table: pa.Table) -> pa.Table:
    """Maximal repeats among the different surroundings of one hash bucket: a row for each member."""
    contexts = np.frombuffer(b"".join(table.column("context").to_pylist()), np.uint8).reshape(-1, CONTEXT)
    order = np.argsort(contexts.view(f"S{CONTEXT}").ravel(), kind="stable")
    contexts = contexts[order]
    digests = [table.column("digest")[int(i)].as_py() for i in order]
    times = table.column("n").to_numpy()[order]
    out = {}  # what is all of one surrounding may also be a part of others

    def group(back: int, ahead: int, members: list[int]) -> None:
        first = contexts[members[0]]
        content = first[SPAN : SPAN + back][::-1].tobytes() + b"\0" + first[:ahead].tobytes()
        name = hashlib.md5(content).hexdigest()
        out.update(((name, digests[m]), (name, back + ahead, back, digests[m])) for m in members)

    left, right = reach(contexts)
    for i in np.flatnonzero(times > 1).tolist():  # equal as far as the surroundings go
        group(int(left[i]), int(right[i]), [i])
    common = agreement(contexts[:-1, :SPAN], contexts[1:, :SPAN])
    ends = np.concatenate((np.flatnonzero(common < GRAM), [len(contexts) - 1]))
    begins = np.concatenate(([0], ends[:-1] + 1))
    for a, b in zip(begins[ends > begins].tolist(), ends[ends > begins].tolist()):
        rights = [r.tobytes() for r in contexts[a : b + 1, :SPAN]]
        lefts = [r.tobytes() for r in contexts[a : b + 1, SPAN:]]
        for back, ahead, members in maximal_repeats(rights, lefts, common[a:b].tolist()):
            group(back, ahead, [a + m for m in members])
    return _rows(list(out.values()), ("group", "length", "back", "digest"), (pa.string(), pa.int32(), pa.int32(), pa.binary()))


def repeat_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(group, length, doc_id, start): a row for every occurrence of every maximal repeat.

    A repeat is a string of ``SPAN`` bytes or more around an anchor, at most
    ``BEFORE`` bytes before it and ``SPAN`` from it on; it is maximal if its
    occurrences do not all go on alike on either side within these bounds. A
    longer passage is covered by the groups of its anchors. ``group`` names the
    string and the anchor's place in it; ``start`` is in bytes. Null ids come as
    null; texts below ``SPAN`` bytes, null and empty ones are in no group.

    Hashes, places and group members are plain rows that Spark counts and joins,
    so what moves grows with the anchors; different surroundings alone are
    compared, and their copies are joined to the groups found. Groups nest: a place
    with many edited copies is in a group for each way in which they agree, so
    the result can be far larger than the texts. What removal needs of it is in
    `remove_repeats`, which keeps the longest spans alone.
    """
    bounded_batches(docs)
    buckets = bucket_count(text_bytes(docs, text), BUCKET_BYTES, LEAST_BUCKETS)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("order"),
        F.col(f"`{text}`").alias("text"),
    )
    rows = rows.withColumn("p", F.pmod(F.xxhash64("row"), F.lit(buckets))).repartition(buckets, "p")
    listed = rows.groupBy("p").applyInArrow(lean(list_anchors), ANCHORS)
    often = listed.groupBy("value").agg(F.sum("n").alias("total")).where("total > 1").select("value")
    repeated = listed.select("value", "p").join(often, "value")
    places = rows.groupBy("p").cogroup(repeated.groupBy("p")).applyInArrow(lean_pair(list_places), PLACES)
    places = frozen(places, "repeat-places")
    contexts = places.groupBy("value", "digest").agg(F.count("*").alias("n"), F.max("context").alias("context"))
    contexts = contexts.withColumn("b", F.pmod("value", F.lit(FINER * buckets)))
    groups = frozen(contexts.groupBy("b").applyInArrow(lean(list_groups), GROUPS), "repeat-groups")
    null_id = np.iinfo(np.int64).max
    return groups.join(places.select("digest", "order", "start"), "digest").select(
        "group",
        "length",
        F.when(F.col("order") != int(null_id), F.col("order")).alias("doc_id"),
        (F.col("start") - F.col("back")).alias("start"),
    )
