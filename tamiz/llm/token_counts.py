"""Token counts under a unigram model by dynamic programming over a trie.

The pre-tokens of the texts are inserted in a trie. A node keeps the best
score of any segmentation of its path and that segmentation's number of
tokens; both follow from the nodes above it, so a prefix that many pre-tokens
share is computed once. A pre-token's count is kept where it ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches

#: Nodes that a task keeps before it starts a new trie.
NODES = 1_500_000
SPACE = "▁"
NO_END = object()


def zipf_scores(path: str) -> dict[str, float]:
    """Log-probabilities of the pieces of a SentencePiece file.

    The file ranks its pieces and gives no probabilities; a Zipf-Mandelbrot law
    over the rank, p ~ 1 / (rank + 2.7), stands for them. Pieces for single
    bytes have no rank by use and are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [
        (i, model.id_to_piece(i)) for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    whole = math.log(sum(1 / (rank + 2.7) for rank in range(1, len(pieces) + 1)))
    return {piece: -math.log(rank + 2.7) - whole for rank, (_, piece) in enumerate(pieces, 1)}


class CountTrie(dict):
    """Counts of pre-tokens by ``self[word]``; ``scores`` are log-probabilities of pieces.

    A character that is no piece itself may also be spelt by its UTF-8 bytes,
    each a token with the least score. Among equally good segmentations the one
    with fewest tokens counts.
    """

    def __init__(self, scores: dict[str, float], limit: int = NODES):
        super().__init__()
        self.scores, self.limit = scores, limit
        #: Ends of pieces; None for those that are no pieces themselves.
        self.ends: dict[str, float | None] = dict.fromkeys(p[k:] for p in scores for k in range(1, len(p)))
        self.ends.update(scores)
        self.least = min(scores.values(), default=0.0)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.children: dict[tuple[int, str], int] = {}
        self.best = [0.0]
        self.tokens = [0]

    def grow(self, path: list[int], word: str, depth: int) -> int:
        """The node for ``word[:depth]`` below the nodes of ``path``."""
        best, tokens, ends = self.best, self.tokens, self.ends
        top, least = -math.inf, 0
        if word[depth - 1] not in self.scores:
            spelt = len(word[depth - 1].encode())
            top, least = best[path[-1]] + spelt * self.least, tokens[path[-1]] + spelt
        for start in range(depth - 1, -1, -1):
            score = ends.get(word[start:depth], NO_END)
            if score is NO_END:  # no piece ends with this, so none with more
                break
            if score is None:
                continue
            node = path[start]
            score += best[node]
            if score > top or (score == top and tokens[node] + 1 < least):
                top, least = score, tokens[node] + 1
        best.append(top)
        tokens.append(least)
        return len(best) - 1

    def __missing__(self, word: str) -> int:
        if len(self.best) > self.limit:
            self.reset()
        path, marked = [0], SPACE + word
        for depth, char in enumerate(marked, 1):
            key = (path[-1], char)
            node = self.children.get(key)
            if node is None:
                node = self.children[key] = self.grow(path, marked, depth)
            path.append(node)
        self[word] = count = self.tokens[path[-1]]
        return count


def with_counts(docs: DataFrame, model_path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens (long) of every whole text; ``name`` must be new.

    Pre-tokens are runs of characters other than ASCII white space, each with
    the mark of a word's start. Null, empty and blank texts have no tokens.
    ``model_path`` must be at the same place on every executor.
    """

    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = CountTrie(zipf_scores(model_path))
        for texts in batches:
            values = texts.cast(pa.binary()).to_pylist()
            yield pa.array(
                [sum(map(trie.__getitem__, (w.decode() for w in (t or b"").split()))) for t in values], pa.int64()
            )

    bounded_batches(docs)
    return docs.withColumn(name, counts(F.col(f"`{text}`")))
