"""Operator 10: best-fit packing by the sum of squares of open bins per gap.

Documents are tokenised where they lie; only small rows (piece, length, checksum) move on. The
pieces are dealt by hash into groups of a set mean size, and each group is packed on its own:
pieces in falling length, each into the open sequence after which the sum over gaps of the
squared number of open sequences with that gap is smallest; a new one only where none fits.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import slices, texts
from stockflow.session import cut_lineage

#: Mean number of pieces packed together. Groups of this size waste well under 1 %.
GROUP_PIECES = 4000
#: Words whose ids a worker remembers before it starts anew.
CACHE_WORDS = 800_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


#: Text that the vocabulary turns into a token of its own wherever it stands.
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _ranked(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


class Vocabulary(NamedTuple):
    """Files of one byte-level vocabulary: for ``tokenizers``, and the same as ranks with its splitting pattern."""

    json: str
    ranks: str
    pattern: str


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.zeros(1024, kind), 0

    def extend(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.room):
            self.room = np.concatenate([self.room[:self.n], np.zeros(self.n + 2 * len(x), self.room.dtype)])
        self.room[self.n:self.n + len(x)] = x
        self.n += len(x)

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class _Numbers(dict):
    """Numbers words as they are first met and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        k = self[word] = len(self)
        return k


class CachedEncoder:
    """Ids of whole texts, looked up by word.

    The splitting pattern always cuts before a space that is followed by a non-space, so a text is
    the concatenation of its space-led words and equal words have equal ids. Texts where a space
    is followed by white space (or ends the text) are encoded whole. New words are encoded in one
    call and told apart by the byte lengths of their tokens. Texts with the special token's text
    go to ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.vocabulary, self.limit = vocabulary, cache_words
        self.ranked, self.sizes = _ranked(vocabulary.ranks, vocabulary.pattern)
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.starts, self.lens = _Growing(np.uint32), _Growing(np.int64), _Growing(np.int64)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words in their order; length -1 marks one whose texts are encoded whole."""
        one = [w if w and not w[0].isspace() else "" for w in words]
        own = {i: self.ranked.encode_ordinary(w[1:]) for i, w in enumerate(words) if w[:1] == " "}
        sizes = pc.binary_length(pa.array(one, pa.string())).to_numpy().astype(np.int64)
        ids = np.array(self.ranked.encode_ordinary("".join([" " + w for w in one if w])), np.uint32)
        ends = np.cumsum(self.sizes[ids])
        real = sizes > 0
        cuts = np.searchsorted(ends, np.cumsum(1 + sizes[real])) + 1
        starts, lens = np.zeros(len(words), np.int64), np.full(len(words), -1)
        lens[real] = np.diff(cuts, prepend=0)
        starts[real] = cuts - lens[real]
        used, extra = len(ids), []
        for i, x in own.items():
            starts[i], lens[i] = used, len(x)
            used += len(x)
            extra.extend(x)
        self.starts.extend(self.flat.n + starts)
        self.lens.extend(lens)
        self.flat.extend(np.append(ids, np.array(extra, np.uint32)))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.numbers) > self.limit:
            self._clear()
        number, docs = self.numbers.__getitem__, []
        for t in texts:
            words = t.split(" ")
            words[0] = " " + words[0]                      # only a text's first word has such a key
            docs.append(np.fromiter(map(number, words), np.int64, len(words)))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        flat, starts, lens = self.flat.all, self.starts.all, self.lens.all
        for t, k in zip(texts, docs):
            n = lens[k]
            if SPECIAL in t:
                yield np.array(_tokenizer(self.vocabulary.json).encode(t, add_special_tokens=False).ids, np.uint32)
            elif n.min() < 0:
                yield np.array(self.ranked.encode_ordinary(t), np.uint32)
            else:
                ends = np.cumsum(n)
                yield flat[np.arange(int(ends[-1])) + np.repeat(starts[k] - (ends - n), n)]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, the first piece taking the remainder."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Tokenise every document and cut it into pieces of at most ``capacity`` tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = CachedEncoder(vocabulary)
        for b in slices(batches, 1000):
            out: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(texts(b.column(1)))):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                start = 0
                for k, n in enumerate(piece_lengths(len(ids), capacity)):
                    out.append((doc, k, start, n, zlib.crc32(ids[start:start + n].tobytes())))
                    start += n
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; bins are numbered from 0.

    With ``open[g]`` the number of open bins of gap ``g``, putting ``s`` into gap ``g`` changes
    the sum of squares by ``2 (open[g-s] - open[g]) + 2``, or by ``1 - 2 open[s]`` where it fills
    the bin. Ties go to the smallest gap, then to the bin that got this gap last.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    far, made = np.int64(1) << 60, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        fits = count[s:capacity]
        gap = 0
        if len(fits):
            rise = 2 * (count[:capacity - s] - fits) + 2
            rise[0] = 1 - 2 * fits[0]
            rise[fits == 0] = far
            j = int(rise.argmin())
            if fits[j]:
                gap = s + j
        if gap:
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            b, gap, made = made, capacity, made + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            stacks.setdefault(gap - s, []).append(b)
    return bins, offsets


def best_fit_pack(docs: DataFrame, vocabulary: Vocabulary, capacity: int = 2048, id_col: str = "doc_id",
                  text_col: str = "text", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    A document is its token ids followed by id 0. Only documents longer than a sequence are cut;
    their first piece takes the remainder. Returns one row per piece: ``doc_id``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Null and empty texts are one piece of one token. Rows that repeat an id are packed each on
    its own. Null ids are kept. Other columns are ignored; an empty table gives no rows. Very
    long texts become many pieces, dealt over all groups, and so are rows alike in every column. The
    same rows in the same partitions give the same packing.
    """
    p = cut_lineage(pieces(docs, vocabulary, capacity, id_col, text_col))
    groups = max(1, round(p.count() / group_pieces))
    dealt = p.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")]).drop_columns("_g")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        ids = (np.int64(key[0].as_py()) << 32) + bins
        return rows.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("_g").applyInArrow(pack, PACKED)
