"""Packing by power-of-two decomposition.

Each document is cut into pieces whose lengths are powers of two: as many of
the greatest length as fit, then the binary digits of the rest. Every piece is
a sequence of its own, so no sequence crosses documents and none is padded;
pieces of equal length form a bucket, from which batches are drawn.
"""

from __future__ import annotations

import string
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches, release_memory

PIECES = (
    "doc_id {id_type}, start long, length long, doc_tokens long, bucket int, ids binary"
)
#: Encoded words of one generation; a Python worker keeps two, over all its tasks.
CACHED_WORDS = 400_000
#: Punctuation that never shares a pre-token with a letter or number before it.
MARKS = ".,;:!?"


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, greatest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class WordIds(dict):
    """Ids of a white-space-free string as little-endian 32-bit integers, encoded once.

    The tokenizer drops white space, lower-cases, and joins characters neither
    across white space nor across the border of a letter or number and
    ``MARKS``, so a text's ids are those of such parts one after another. It
    does join ``MARKS`` to other symbols before them; such words are encoded
    whole. Strings that may hold a special token ("<|") are encoded as they
    stand. A full generation of words makes way for a new one, which takes over
    what is met again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[str, bytes] = {}
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = string.ascii_lowercase
        normal = normalizer.normalize_str(letters) if normalizer else letters
        #: Whether a word of the letters a-z reaches the model as it stands, in one piece.
        self.plain = splitter is not None and [x for x, _ in splitter.pre_tokenize_str(normal)] == [letters]
        self.apart: dict[str, bool] = {}

    def parts_from_marks(self, char: str) -> bool:
        """Whether each of ``MARKS`` is a pre-token of its own after ``char``, as the tokenizer has it."""
        if char not in self.apart:
            normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
            pairs = [normalizer.normalize_str(char + m) if normalizer else char + m for m in MARKS]
            self.apart[char] = splitter is not None and all(
                splitter.pre_tokenize_str(pair)[-1][0] == m for pair, m in zip(pairs, MARKS)
            )
        return self.apart[char]

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        if word in self.older:
            packed = self.older[word]
        elif "<|" in word:
            packed = self.encoded(word)
        elif core and core != word and self.parts_from_marks(core[-1]):
            packed = self[core] + self[word[len(core) :]]
        elif word.isascii() and word != word.lower():
            packed = self[word.lower()]
        else:
            packed = self.encoded(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = packed
        return packed

    def encoded(self, word: str) -> bytes:
        if self.plain and word.isascii() and word.isalpha() and word.islower():
            ids = [token.id for token in self.tokenizer.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def worker_words(path: str) -> WordIds:
    """The ``WordIds`` of this Python process; tasks that run in it one after another share them."""
    held = sys.modules.setdefault("tamiz_llm_words", types.ModuleType("tamiz_llm_words")).__dict__
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, bucket, ids, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers, ``bucket`` is log2 of
    the length, ``sequence_id`` is unique and ``offset`` always 0, as a piece
    fills its sequence. ``tokenizer_path`` names a file of ``tokenizers`` whose
    pre-tokenizer drops white space, at the same place on every executor;
    ``end_id`` closes each document.

    No shuffle: a document is cut where it is read. Null and empty texts have
    the one id ``end_id``; a null doc_id stays null; repeated rows are packed
    one by one; other columns are ignored; an empty table has no pieces.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = PIECES.format(id_type=source.schema["doc_id"].dataType.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []
            for r, value in enumerate(batch.column(1).to_pylist()):
                packed = words.of(value or "") + end
                at, n = 0, len(packed) // 4
                for size in piece_lengths(n, longest):
                    row.append(r)
                    start.append(at)
                    length.append(size)
                    total.append(n)
                    ids.append(packed[4 * at : 4 * (at + size)])
                    at += size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array([n.bit_length() - 1 for n in length], pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "bucket", "ids"],
            )
        release_memory()

    bounded_batches(docs)
    pieces = source.mapInArrow(cut, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Writes the pieces in one folder per length; a folder's rows are equally long."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
