"""Toxicity: a bidirectional gated recurrent network with attention, written in numpy.

Texts are read in overlapping windows of words. A word enters as the vector of
the word itself, if it was learnt, and the mean vector of its character
trigrams. Two recurrent layers read the window in both directions, attention
weighs their states, and a logistic unit scores the pooled state. A text's
score is that of its worst window.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches, frozen
from tamiz.llm.labelled import training_rows

LENGTH = 16
STRIDE = 8
HIDDEN = 8
WORD_DIM = 8
CHAR_DIM = 8
CHAR_BUCKETS = 1 << 13
VOCABULARY = 20_000
#: Documents of each label learnt from, with all of their windows.
SAMPLE = 2400
#: Windows of a document that a round takes, at most.
HARD = 4
#: Toxic texts from which a word's preference counts whole.
SURE = 10
#: Clean windows for each toxic one in training.
CLEAN_SHARE = 8
#: What a word's preference counts for in its first vector.
PREFERENCE = 0.3
ROUNDS = 4
EPOCHS = 4
#: Score at which a text is called toxic, and what a clean text above it weighs against a toxic one.
CUTOFF, FALSE = 0.3, 4.0
#: How far from the clean side the cutoff lies; learnt texts part more widely than others.
BETWEEN = 0.05
#: Characters of a window that is learnt from, at most.
WINDOW_CHARS = 2_000
DECAY = 0.002
STRIP = ".,;:!?\"'()[]{}*-_"
KNOWN_WORDS = 300_000
f32 = np.float32


def word_core(word: str) -> str:
    return word.lower().strip(STRIP) or word


def window_starts(n: int) -> range:
    """Starts of the overlapping windows that cover ``n`` words; one even without words."""
    return range(0, max(1, n - LENGTH + STRIDE), STRIDE)


def trigram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of ``^word$`` one after another, and the first of each word."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    at = np.arange(sizes.sum()) + 2 * np.repeat(np.arange(len(words)), sizes)
    mixed = (codes[at] * np.uint64(0x9E3779B1) + codes[at + 1]) * np.uint64(0x85EBCA77) + codes[at + 2]
    mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS, firsts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, vocabulary: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}  # row 0: any other word

        def normal(*shape, scale=0.1):
            return rng.normal(0, scale, shape).astype(f32)

        dim = WORD_DIM + CHAR_DIM
        self.p = {"words": normal(len(vocabulary) + 1, WORD_DIM), "chars": normal(CHAR_BUCKETS, CHAR_DIM, scale=0.3)}
        for side in "fb":
            self.p[f"x{side}"] = normal(dim, 3 * HIDDEN, scale=0.4)
            self.p[f"h{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.p[f"g{side}"] = np.zeros(3 * HIDDEN, f32)
        self.p |= {"aw": normal(2 * HIDDEN, HIDDEN, scale=0.4), "av": normal(HIDDEN, scale=0.4)}
        self.p |= {"o": normal(2 * HIDDEN, scale=0.4), "ob": np.zeros(1, f32)}
        self.constant: float | None = None

    def word_vectors(self, words: list[str]) -> np.ndarray:
        row = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        buckets, firsts = trigram_buckets(words)
        sizes = np.diff(np.append(firsts, len(buckets)))
        chars = np.add.reduceat(self.p["chars"][buckets], firsts) / np.sqrt(sizes)[:, None]
        return np.concatenate((self.p["words"][row], chars.astype(f32)), axis=1)

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        sides = [vectors @ self.p[f"x{s}"] + self.p[f"g{s}"] for s in "fb"]
        return np.concatenate(sides, axis=1)

    def _layer(self, gates: np.ndarray, mask: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        n, length = mask.shape
        u, h = self.p[f"h{side}"], np.zeros((n, HIDDEN), f32)
        out = np.empty((n, length, HIDDEN), f32)
        for t in range(length) if side == "f" else reversed(range(length)):
            m, g, s = mask[:, t, None], gates[:, t], h @ u
            rz = sigmoid(g[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            new = m * ((1 - z) * c + z * h) + (1 - m) * h
            if keep is not None:
                keep.append((t, h, s, r, z, c))
            out[:, t] = h = new
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows: ``gates`` (window, word, both directions' gates), ``mask`` 1 where there is a word."""
        steps = {s: [] if keep is not None else None for s in "fb"}
        half = 3 * HIDDEN
        states = np.concatenate(
            [self._layer(gates[:, :, k * half : (k + 1) * half], mask, s, steps[s]) for k, s in enumerate("fb")], axis=2
        )
        looked = np.tanh(states @ self.p["aw"])
        weight = np.where(mask > 0, looked @ self.p["av"], -1e4)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True)) * mask
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = (weight[:, :, None] * states).sum(axis=1)
        if keep is not None:
            keep |= {"steps": steps, "states": states, "looked": looked, "weight": weight, "pooled": pooled}
        return pooled @ self.p["o"] + self.p["ob"][0]

    def backward(self, keep: dict, mask: np.ndarray, error: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the shared parameters and of ``gates``."""
        states, looked, weight = keep["states"], keep["looked"], keep["weight"]
        grad = {"o": error @ keep["pooled"], "ob": np.array([error.sum()], f32)}
        dpool = error[:, None] * self.p["o"]
        dstates = weight[:, :, None] * dpool[:, None]
        dw = (states * dpool[:, None]).sum(axis=2)
        dw = weight * (dw - (weight * dw).sum(axis=1, keepdims=True))
        grad["av"] = np.einsum("nt,ntk->k", dw, looked)
        dlooked = dw[:, :, None] * self.p["av"] * (1 - looked**2)
        grad["aw"] = np.einsum("ntj,ntk->jk", states, dlooked)
        dstates += dlooked @ self.p["aw"].T
        dgates = np.zeros((*mask.shape, 6 * HIDDEN), f32)
        for k, s in enumerate("fb"):
            u, du = self.p[f"h{s}"], np.zeros_like(self.p[f"h{s}"])
            dh = np.zeros((len(mask), HIDDEN), f32)
            for t, h, sums, r, z, c in reversed(keep["steps"][s]):
                m = mask[:, t, None]
                total = dh + dstates[:, t, k * HIDDEN : (k + 1) * HIDDEN]
                d = m * total
                dc = d * (1 - z) * (1 - c**2)
                dz = d * (h - c) * z * (1 - z)
                dr = dc * sums[:, 2 * HIDDEN :] * r * (1 - r)
                dgates[:, t, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN] = np.concatenate((dr, dz, dc), axis=1)
                dsums = np.concatenate((dr, dz, dc * r), axis=1)
                du += h.T @ dsums
                dh = d * z + (1 - m) * total + dsums @ u.T
            grad[f"h{s}"] = du
        return grad, dgates

    def fit(self, windows: list[list[str]], labels: np.ndarray, epochs: int, seed: int = 4) -> None:
        """Adam for the network, AdaGrad for the rows of vectors that a batch touches.

        Word vectors are left out at random, so that the characters learn too.
        """
        words = sorted({w for window in windows for w in window})
        place = {w: i for i, w in enumerate(words)}
        ids = np.zeros((len(windows), LENGTH), np.int64)
        mask = np.zeros((len(windows), LENGTH), f32)
        for i, window in enumerate(windows):
            ids[i, : len(window)] = [place[w] for w in window]
            mask[i, : len(window)] = 1
        row = np.array([self.vocabulary.get(w, 0) for w in words])
        buckets, firsts = trigram_buckets(words)
        sizes = np.diff(np.append(firsts, len(buckets)))
        shared = [k for k in self.p if k not in ("words", "chars")]
        first, second = ({k: np.zeros_like(self.p[k]) for k in shared} for _ in range(2))
        seen = {k: np.full_like(self.p[k], 1e-3) for k in ("words", "chars")}
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // 48)):
                step += 1
                used, inverse = np.unique(ids[batch], return_inverse=True)
                inverse = inverse.reshape(len(batch), LENGTH)
                vectors = self.word_vectors([words[i] for i in used])
                vectors[:, :WORD_DIM] *= (rng.random((len(used), 1)) < 0.6).astype(f32)
                m, keep = mask[batch], {}
                z = self.forward(self.inputs(vectors)[inverse], m, keep)
                error = ((sigmoid(z) - labels[batch]) / len(batch)).astype(f32)
                grad, dgates = self.backward(keep, m, error)
                flat = dgates.reshape(-1, 6 * HIDDEN)
                per_word = np.zeros((len(used), 6 * HIDDEN), f32)
                np.add.at(per_word, inverse.ravel(), flat)
                dvectors = np.zeros_like(vectors)
                for k, s in enumerate("fb"):
                    part = per_word[:, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN]
                    grad[f"x{s}"], grad[f"g{s}"] = vectors.T @ part, part.sum(axis=0)
                    dvectors += part @ self.p[f"x{s}"].T
                for k in shared:
                    first[k] = 0.9 * first[k] + 0.1 * grad[k]
                    second[k] = 0.99 * second[k] + 0.01 * grad[k] ** 2
                    self.p[k] -= (0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(f32)
                self._update("words", row[used], dvectors[:, :WORD_DIM], seen)
                owner = np.repeat(np.arange(len(used)), sizes[used])
                places = np.concatenate([np.arange(firsts[i], firsts[i] + sizes[i]) for i in used])
                spread = dvectors[:, WORD_DIM:] / np.sqrt(sizes[used])[:, None]
                self._update("chars", buckets[places], spread[owner], seen)

    def _update(self, name: str, rows: np.ndarray, grads: np.ndarray, seen: dict) -> None:
        touched, inverse = np.unique(rows, return_inverse=True)
        g = np.zeros((len(touched), grads.shape[1]), f32)
        np.add.at(g, inverse, grads)
        seen[name][touched] += g**2
        self.p[name][touched] -= 0.1 * g / np.sqrt(seen[name][touched]) + DECAY * self.p[name][touched]

    def scores(self, windows: list[list[str]]) -> np.ndarray:
        scorer = Scorer(self)
        return scorer.of_windows([scorer.ids(w) for w in windows])


class Scorer(dict):
    """Scores texts; keeps what each word adds to the gates, for a bounded number of words."""

    def __init__(self, network: Network):
        super().__init__()
        self.network = network
        self.gates = np.zeros((1, 6 * HIDDEN), f32)  # row 0: no word
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self.gates) + len(self.fresh)
        self.fresh.append(word_core(word))
        return row

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def settle(self) -> None:
        for k in range(0, len(self.fresh), 20_000):
            part = self.fresh[k : k + 20_000]
            self.gates = np.concatenate((self.gates, self.network.inputs(self.network.word_vectors(part))))
        self.fresh = []

    def of_windows(self, windows: list[np.ndarray]) -> np.ndarray:
        """Scores of windows of word rows."""
        self.settle()
        out = []
        for k in range(0, len(windows), 2048):
            part = windows[k : k + 2048]
            sizes = np.array([len(w) for w in part])
            mask = (np.arange(LENGTH) < sizes[:, None]).astype(f32)
            rows = np.zeros((len(part), LENGTH), np.int64)
            rows[mask > 0] = np.concatenate(part) if sizes.any() else []
            out.append(sigmoid(self.network.forward(self.gates[rows], mask)))
        return np.concatenate(out) if out else np.zeros(0)

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Score of the worst window of each text."""
        result = np.empty(len(texts))
        pending: list[np.ndarray] = []
        firsts: list[int] = []
        begin = 0
        for i, text in enumerate(texts):
            ids = self.ids(text.split())
            firsts.append(len(pending))
            pending += [ids[a : a + LENGTH] for a in window_starts(len(ids))]
            if len(pending) >= 8192 or i + 1 == len(texts):
                result[begin : i + 1] = np.maximum.reduceat(self.of_windows(pending), firsts)
                begin, pending, firsts = i + 1, [], []
                if len(self) > KNOWN_WORDS:
                    self.clear()
                    self.gates = self.gates[:1]
        return result


def _windows_of(words: list[str]) -> list[list[str]]:
    """All windows of one text, in the order of their hashes; those of more than ``WINDOW_CHARS`` are not learnt from."""
    windows = [words[a : a + LENGTH] for a in window_starts(len(words))]
    windows = [w for w in windows if sum(map(len, w)) <= WINDOW_CHARS] or [[]]
    return sorted(windows, key=lambda w: zlib.crc32(" ".join(w).encode("utf-8", "replace")))


def _cores(text: str | None) -> list[str]:
    return list(map(word_core, (text or "").split()))


def word_counts(rows: DataFrame, text: str) -> dict[str, tuple[int, int]]:
    """Clean and toxic texts that hold a word, of the ``VOCABULARY`` words in most texts, three at least."""

    @F.arrow_udf("array<string>")
    def held(texts: pa.Array) -> pa.Array:
        found = [sorted({w for w in _cores(t) if len(w) <= WINDOW_CHARS}) for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.string()))

    words = rows.select("label", F.explode(held(F.col(f"`{text}`"))).alias("word")).groupBy("word")
    counted = words.agg(F.count_if(F.col("label") == 0).alias("clean"), F.count_if(F.col("label") == 1).alias("toxic"))
    often = counted.where("clean + toxic > 2").orderBy(F.desc(F.col("clean") + F.col("toxic")), "word").limit(VOCABULARY)
    return {r["word"]: (r["clean"], r["toxic"]) for r in often.collect()}


def picked(rows: DataFrame, text: str, choose) -> dict[int, list[list[str]]]:
    """Windows by label: of every text those that ``choose`` of (label, windows) names, at most ``HARD``.

    All windows of a text are made and judged in the task that holds it; the driver gets the chosen ones.
    """

    def windows(batches):
        for batch in batches:
            ids, labels, texts = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for doc_id, label, value in zip(ids, labels, texts):
                own = _windows_of(_cores(value))
                out += [(doc_id, label, k, own[i]) for k, i in enumerate(choose(label, own)[:HARD])]
            columns = list(zip(*out)) if out else [(), (), (), ()]
            types = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=["doc_id", "label", "k", "window"]
            )

    source = rows.select("doc_id", "label", F.col(f"`{text}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    chosen = source.mapInArrow(windows, f"doc_id {kind}, label int, k int, window array<string>").collect()
    found: dict[int, list[list[str]]] = {0: [], 1: []}
    for r in sorted(chosen, key=lambda r: (r["doc_id"], r["k"])):
        found[r["label"]].append(list(r["window"]))
    return found


def fit(
    docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, doc_id: str = "doc_id", text: str = "text"
) -> Network:
    """Learns from all windows of at most ``bound`` documents of each label.

    A label names a text, not a window. The window of a toxic text is first the
    one with the word that most prefers toxic texts; in later rounds it is the
    one that the network finds worst, and the clean windows that it finds worst
    are added. Texts are cut and their windows judged by the tasks; the driver
    holds words and windows in numbers that ``bound`` and the constants fix.
    Without labels of both kinds all scores are 0.5 or the one label.
    """
    bounded_batches(docs)
    rows = frozen(training_rows(docs, labels, "toxic", bound, doc_id=doc_id, columns=(text,)), "toxicity-sample")
    texts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(texts) < 2:
        network = Network([])
        network.constant = float(next(iter(texts))) if texts else 0.5
        return network
    counts = word_counts(rows, text)

    def preference(word: str) -> float:
        clean, toxic = counts.get(word, (0, 0))
        ratio = ((toxic + 0.1) / (texts[1] + 1)) / ((clean + 0.1) / (texts[0] + 1))
        return float(np.log(ratio)) * min(1.0, toxic / SURE)

    def by_words(label: int, windows: list) -> list[int]:
        if label == 0:
            return list(range(len(windows)))
        return [max(range(len(windows)), key=lambda i: max(map(preference, windows[i]), default=-9.0))]

    network = Network(list(counts))
    # A word vector begins with how much toxic texts prefer the word.
    network.p["words"][1:, 0] = [PREFERENCE * preference(w) for w in counts]
    first = picked(rows, text, by_words)
    clean, worst = first[0], first[1]
    for last in [False] * (ROUNDS - 1) + [True]:
        times = max(1, round(len(clean) / len(worst) / CLEAN_SHARE))
        labels_of = np.concatenate((np.zeros(len(clean)), np.ones(len(worst) * times))).astype(f32)
        network.fit(clean + worst * times, labels_of, EPOCHS)
        if not last:

            def by_score(label: int, windows: list) -> list[int]:
                scores = network.scores(windows)
                order = np.argsort(-scores, kind="stable").tolist()
                return order[:1] if label == 1 else [i for i in order[:HARD] if scores[i] > 0.02]

            found = picked(rows, text, by_score)
            worst = found[1]
            clean = clean + found[0]
    # Where texts part best, the score is CUTOFF.
    scored = with_score(rows.select("label", F.col(f"`{text}`").alias("text")), network, name="own").select("label", "own")
    sample = sorted((r["own"], r["label"]) for r in scored.collect())
    part = best_cutoff(np.array([x for x, _ in sample]), np.array([y for _, y in sample]))
    network.p["ob"] += np.log(CUTOFF / (1 - CUTOFF)) - np.log(part / (1 - part))
    return network


def best_cutoff(scores: np.ndarray, labels: np.ndarray) -> float:
    """Where to part ascending scores: the most toxic texts at or above it, less ``FALSE`` times the clean ones, as shares.

    ``BETWEEN`` the scores on both sides, of equally good places the lowest.
    """
    above = np.concatenate((np.cumsum(labels[::-1])[::-1], [0])) / labels.sum()
    wrong = np.concatenate((np.cumsum((1 - labels)[::-1])[::-1], [0])) / (1 - labels).sum()
    edges = np.clip(np.concatenate(([0.0], scores, [1.0])), 1e-6, 1 - 1e-6)
    gain = np.where(edges[1:] > edges[:-1], above - FALSE * wrong, -np.inf)
    i = int(gain.argmax())
    logits = np.log(edges[i : i + 2] / (1 - edges[i : i + 2]))
    return float(1 / (1 + np.exp(-(logits[0] + BETWEEN * (logits[1] - logits[0])))))


def with_score(docs: DataFrame, network: Network, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability (double) that the worst window of each whole text is toxic.

    Null, empty and blank texts are one window without words. Equal texts get
    equal scores; ``name`` must be new.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if network.constant is not None:
            return pa.array([network.constant] * len(texts), pa.float64())
        return pa.array(Scorer(network).of_texts([t or "" for t in texts.to_pylist()]), pa.float64())

    bounded_batches(docs)
    return docs.withColumn(name, score(F.col(f"`{text}`")))
