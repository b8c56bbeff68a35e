"""Operator 6: language-model scores by prediction by partial matching.

One pass over the training texts counts byte 5-grams and words; both are summed by grouped
aggregation over the whole corpus. The 5-grams are a trie of contexts of four bytes whose shorter
contexts are sums over the leading byte. A byte is predicted by its longest known context; if the
context has not seen it, the model escapes (method C: as many escapes as distinct symbols) to the
next shorter one, in which all symbols of the longer one are excluded. Because every symbol seen
after a context is also seen after its suffix, the excluded counts are one number per context, so
the whole chain is a few table look-ups per byte.

The trie is whole and grows with the corpus. Its most frequent contexts, with all their shorter
ones, travel with the scorers; a byte after any other context is set aside by its 5-gram. The
distinct 5-grams set aside meet the corpus's 5-grams by their last three context bytes, where a
partition holds everything after these contexts and works out the same chain, and return to their
texts in a join. A context of three bytes has at most 65 536 5-grams, so none of them is hot.

The word scores need the count of every word. Words above a share of all tokens are few by
arithmetic (at most one over that share) and travel with the scorers; the others meet their
counts in the same join.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import crc_fold, slices, text_bytes
from stockflow.session import cut_lineage

ORDER = 4
#: Contexts of four bytes that travel with the scorers, the most frequent first; no score depends on it.
CONTEXTS = 1 << 17
#: 5-grams, wanted or counted, in a partition that scores the rest.
SHARD_GRAMS = 1 << 20
#: Words with at least this share of all training tokens travel with the scorers.
COMMON_SHARE = 2.0 ** -20
#: Distinct counts a task holds before it hands them on.
HELD = 3_000_000
GRAMS, WORDS, ENDS = 0, 1, 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEY_BITS = np.uint64(8 * (ORDER + 1))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with its four predecessors (zeros before the start) as one number, and text ends."""
    pad = b"\0" * ORDER
    a = np.frombuffer(pad + pad.join(texts), np.uint8).astype(np.uint64)
    n = len(a) - ORDER
    key = np.zeros(n, np.uint64)
    for i in range(ORDER + 1):
        key = (key << np.uint64(8)) | a[i:i + n]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(np.arange(len(texts)) * ORDER, lens)
    return key[at], ends


def word_types(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """64-bit hashes of the distinct lower-cased words of a batch, and each text as numbers of them."""
    index: dict[bytes, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in t.lower().split()], np.int64) for t in texts]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, index), np.uint64, len(index)).view(np.int64), docs


def _sum_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    u, at = np.unique(k, return_inverse=True)
    return u, np.bincount(at, n, len(u)).astype(np.int64)


def count(docs: DataFrame, text_col: str) -> DataFrame:
    """Counts ``n`` of 5-grams, words and text ends: ``kind``, ``key``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {GRAMS: ([], []), WORDS: ([], [])}
        size, ends = 0, 0

        def out(kind: int) -> pa.RecordBatch:
            k, n = _sum_up(*held[kind]) if held[kind][0] else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            held[kind] = ([], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.astype(np.int64)), pa.array(n)], names=["kind", "key", "n"])

        for b in slices(batches, 500):
            texts = text_bytes(b.column(0))
            ends += len(texts)
            g, n = np.unique(gram_keys(texts)[0], return_counts=True)
            h, nums = word_types(texts)
            for kind, k, c in ((GRAMS, g.view(np.int64), n), (WORDS, h, np.bincount(np.concatenate(nums), minlength=len(h)))):
                held[kind][0].append(k)
                held[kind][1].append(c)
                size += len(k)
            if size > HELD:
                size = 0
                for kind in (GRAMS, WORDS):
                    k, c = _sum_up(*held[kind])
                    held[kind] = ([k], [c])
                    if len(k) > HELD // 2:
                        yield out(kind)
                    else:
                        size += len(k)
        yield out(GRAMS)
        yield out(WORDS)
        yield pa.RecordBatch.from_arrays([pa.array([ENDS], pa.int32()), pa.array([0], pa.int64()), pa.array([ends], pa.int64())],
                                         names=["kind", "key", "n"])

    return (docs.select(text_col).mapInArrow(run, "kind int, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


class Trie:
    """Counts after contexts of 0 to ``ORDER`` bytes, as sorted arrays, with the escape chain.

    ``grams``: per order the numbers (context bytes, symbol) in order, and their counts.
    """

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]):
        self.name = uuid.uuid4().hex
        self.grams = grams
        ctx, total, kinds, self.entry, self.log_n = [], [], [], [], []
        for key, n in grams:                               # contexts of each order in one numbering
            c, first = np.unique(key >> np.uint64(8), return_index=True)
            ctx.append(c)
            total.append(np.add.reduceat(n, first).astype(float) if len(n) else np.zeros(0))
            kinds.append(np.diff(np.append(first, len(key))).astype(float))
            self.entry.append(key)
            self.log_n.append(np.log10(n))
        self.ctx = ctx
        self.base = np.cumsum([0] + [len(c) for c in ctx])
        t, d = np.concatenate(total), np.concatenate(kinds)
        with np.errstate(divide="ignore"):
            self.log_total = np.log10(t + d)
            self.log_escape = np.log10(d) - self.log_total
        # what is left in the next shorter known context once this one's symbols are excluded
        self.parent = np.full(len(t), -1)
        left_n, left_d = np.zeros(len(t)), np.zeros(len(t))
        for j in range(1, len(grams)):
            key, n = grams[j]
            todo = np.arange(len(ctx[j]))
            number = np.searchsorted(ctx[j], key >> np.uint64(8))
            for low in range(j - 1, -1, -1):
                if not len(todo):
                    break
                up, ok = self._find_context(low, ctx[j][todo])
                mine, up = todo[ok], up[ok]
                self.parent[self.base[j] + mine] = up
                rows = np.isin(number, mine)
                shorter = (key[rows] & np.uint64((1 << (8 * (low + 1))) - 1))
                at = np.searchsorted(self.entry[low], shorter)
                gone = np.bincount(number[rows], grams[low][1][at], len(ctx[j]))
                left_n[self.base[j] + mine] = t[up] - gone[mine]
                left_d[self.base[j] + mine] = d[up] - d[self.base[j] + mine]
                todo = todo[~ok]
        rest = left_n + left_d
        with np.errstate(divide="ignore", invalid="ignore"):
            self.log_rest = np.log10(rest)
            self.log_rest_escape = np.where(left_d > 0, np.log10(left_d) - self.log_rest, 0.0)   # nothing left: go on
        self.unseen = -np.log10(max(1.0, 256 - (d[0] if len(ctx[0]) else 0)))

    def _find_context(self, order: int, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the last ``order`` bytes of contexts, and which of them are known."""
        c = ctx & np.uint64((1 << (8 * order)) - 1)
        known = self.ctx[order]
        if not len(known):
            return np.zeros(len(c), np.int64), np.zeros(len(c), bool)
        at = np.minimum(np.searchsorted(known, c), len(known) - 1)
        return at + self.base[order], known[at] == c

    def _find_entry(self, order: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = key & np.uint64((1 << (8 * (order + 1))) - 1)
        known = self.entry[order]
        if not len(known):
            return np.zeros(len(k)), np.zeros(len(k), bool)
        at = np.minimum(np.searchsorted(known, k), len(known) - 1)
        return self.log_n[order][at], known[at] == k

    def index(self) -> None:
        """Hash table of the longest contexts' symbols: most bytes are answered by one probe."""
        key, n = self.entry[-1], len(self.entry[-1])
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, n)))))
        self.slot_key = np.full(1 << self.bits, _EMPTY)
        self.slot_log = np.zeros(1 << self.bits, np.float32)
        value = (self.log_n[-1] - self.log_total[self.base[-2] + np.searchsorted(self.ctx[-1], key >> np.uint64(8))]).astype(np.float32)
        todo, at = np.arange(n), self._slot(key)
        while len(todo):
            free = self.slot_key[at] == _EMPTY
            first = np.unique(at[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.slot_key[at[put]], self.slot_log[at[put]] = key[todo[put]], value[todo[put]]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, at = todo[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def log10(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each byte given its predecessors (numbers of ``gram_keys``), and
        which bytes follow a context that this trie lacks (their value is 0)."""
        out, rare = np.zeros(len(key)), np.zeros(len(key), bool)
        at, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            found = self.slot_key[at]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_log[at[hit]]
            more = ~hit & (found != _EMPTY)
            if not hit.all():
                miss = todo[~hit & ~more]
                known = self._find_context(ORDER, key[miss] >> np.uint64(8))[1]
                rare[miss[~known]] = True
                out[miss[known]] = self.chain(key[miss[known]])
            todo, at = todo[more], (at[more] + 1) & ((1 << self.bits) - 1)
        return out, rare

    def chain(self, key: np.ndarray) -> np.ndarray:
        """The same for any byte: longest known context, then escapes with exclusion."""
        u, back = np.unique(key, return_inverse=True)
        out = np.zeros(len(u))
        live = np.arange(len(u))
        above = np.full(len(u), -1)                        # the context escaped from
        for j in range(len(self.ctx) - 1, -1, -1):
            if not len(live):
                break
            number, known = self._find_context(j, u[live] >> np.uint64(8))
            at, number = live[known], number[known]
            came = above[at]
            log_n, seen = self._find_entry(j, u[at])
            fresh = came < 0
            bottom = np.where(fresh, self.log_total[number], self.log_rest[came])
            escape = np.where(fresh, self.log_escape[number], self.log_rest_escape[came])
            out[at] += np.where(seen, log_n - bottom, escape)
            above[at] = number
            live = np.sort(np.concatenate([live[~known], at[~seen]]))
        out[live] += self.unseen
        return out[back]


def low_bytes(column: Column, n: int) -> Column:
    return column.bitwiseAND(F.lit((1 << (8 * n)) - 1).cast("long"))


def fit_trie(grams: DataFrame, limit: int = CONTEXTS) -> Trie:
    """The trie of the ``limit`` most frequent contexts of four bytes and all contexts that a chain
    from them can meet, from the corpus's 5-gram counts (``key``, ``n``). Orders 0 to 2 are whole,
    the alphabet bounds them.
    """
    top = (grams.groupBy(F.shiftright("key", 8).alias("c")).agg(F.sum("n").alias("t"))
           .orderBy(F.desc("t"), "c").limit(limit).select(F.col("c").alias("_c")))
    levels = []
    for j in range(ORDER + 1):
        level = grams.groupBy(low_bytes(F.col("key"), j + 1).alias("k")).agg(F.sum("n").alias("n"))
        if j > 2:
            kept = top if j == ORDER else top.select(low_bytes(F.col("_c"), j).alias("_c")).distinct()
            level = level.join(kept, F.shiftright("k", 8) == F.col("_c"), "left_semi")
        got = level.toArrow()
        levels.append(_sorted(got["k"].to_numpy(), got["n"].to_numpy()))
    return Trie(levels)


def _sorted(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(key)
    return key[at].astype(np.uint64), n[at]


def score_rest(grams: DataFrame, wanted: DataFrame, low: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``key`` and ``log`` (log10 probability of its byte) of every distinct 5-gram of ``wanted``.

    ``low``: the whole orders 0 to 2. Both sides are dealt by the last three bytes of the context;
    a partition's 5-grams make its contexts of four and three bytes complete.
    """
    rows = wanted.distinct().select("key", F.lit(0).cast("long").alias("n")).unionByName(grams)
    shards = 1 + rows.count() // SHARD_GRAMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        key, n = (np.concatenate(p) for p in zip(*parts))
        ask = key[n == 0].astype(np.uint64)
        if not len(ask):
            return
        longest = _sorted(key[n > 0], n[n > 0])
        shorter = _sum_up([longest[0] & np.uint64((1 << (8 * ORDER)) - 1)], [longest[1]])
        log = Trie([*low, shorter, longest]).chain(ask)
        for i in range(0, len(ask), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(ask[i:i + 100_000].astype(np.int64)), pa.array(log[i:i + 100_000])],
                                             names=["key", "log"])

    return (rows.repartition(shards, low_bytes(F.shiftright("key", 8), ORDER - 1))
            .mapInArrow(run, "key long, log double"))


_READY: dict[str, Trie] = {}


def _ready(trie: Trie) -> Trie:
    """The trie with its hash table, built once in a worker."""
    if trie.name not in _READY:
        _READY.clear()
        trie.index()
        _READY[trie.name] = trie
    return _READY[trie.name]


SCORED = ("doc_id long, n_tokens long, known long, base double, score double, "
          "word array<long>, word_n array<int>, gram array<long>, gram_n array<int>")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", skip_fold: int = 1,
                contexts: int = CONTEXTS, common_share: float = COMMON_SHARE) -> DataFrame:
    """Language-model scores of every whole text, one row per input row.

    Trained on the texts whose ``crc32(id) mod 5`` is not ``skip_fold``. Returns ``doc_id``,
    ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed word
    counts) and ``score`` (log10 probability of the text's bytes under the trie).

    Null and empty texts have one token, the end, and a score of 0. Null ids count as the empty
    text in the fold. Repeated rows are trained on and returned as often as given. Without any
    training text every byte costs log10(256). Other columns are ignored; an empty table gives no
    rows. Words are told apart by 64-bit hashes. ``contexts`` and ``common_share`` set what travels
    with the scorers, not the results.
    """
    held = crc_fold(F.col(id_col)) == skip_fold
    counts = cut_lineage(count(docs.filter(~held), text_col))
    grams = counts.filter(F.col("kind") == GRAMS).select("key", "n")
    trie = fit_trie(grams, contexts)
    low = trie.grams[:ORDER - 1]
    words = counts.filter(F.col("kind") == WORDS).select("key", "n")
    ends = counts.filter(F.col("kind") == ENDS).agg(F.sum("n")).first()[0] or 0
    size = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = int(size[0] or 0) + ends
    types = size[1] + (1 if ends else 0)
    bottom = float(np.log10(tokens + 0.5 * (types + 1)))
    least = max(1, int(np.ceil(tokens * common_share)))
    got = words.filter(F.col("n") >= least).toArrow()
    order = np.argsort(got["key"].to_numpy())
    common, common_n = got["key"].to_numpy()[order], got["n"].to_numpy()[order]
    common_log = np.log10(common_n + 0.5)
    end_log, end_known = float(np.log10(ends + 0.5)), int(ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _ready(trie)
        for b in slices(batches, 300):
            texts = text_bytes(b.column(1))
            key, ends_at = gram_keys(texts)
            log_p, apart = model.log10(key)
            total = np.append(0.0, np.cumsum(log_p))
            score = np.diff(total[ends_at], prepend=0.0)
            doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(ends_at, prepend=0))
            both, gram_n = np.unique((doc[apart] << _KEY_BITS) | key[apart], return_counts=True)
            gram = (both & ((np.uint64(1) << _KEY_BITS) - np.uint64(1))).astype(np.int64)
            gram_cuts = np.searchsorted(both >> _KEY_BITS, np.arange(len(texts) + 1, dtype=np.uint64))
            h, nums = word_types(texts)
            at = np.minimum(np.searchsorted(common, h), max(0, len(common) - 1))
            known = common[at] == h if len(common) else np.zeros(len(h), bool)
            log = np.where(known, common_log[at], 0.0) if len(common) else np.zeros(len(h))
            n, n_known, base, hs, cs, cuts = [], [], [], [], [], [0]
            for d in nums:
                n.append(len(d) + 1)
                ok = known[d]
                n_known.append(int(ok.sum()) + end_known)
                base.append(float(log[d].sum()) + end_log)
                rest, c = np.unique(d[~ok], return_counts=True)
                hs.append(h[rest])
                cs.append(c)
                cuts.append(cuts[-1] + len(rest))
            def lists(cut, values):
                return pa.ListArray.from_arrays(pa.array(np.asarray(cut, np.int32)), pa.array(values))

            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(score), lists(cuts, np.concatenate(hs)), lists(cuts, np.concatenate(cs).astype(np.int32)),
                 lists(gram_cuts, gram), lists(gram_cuts, gram_n.astype(np.int32))],
                names=["doc_id", "n_tokens", "known", "base", "score", "word", "word_n", "gram", "gram_n"])

    first = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, SCORED)
                        .withColumn("row", F.monotonically_increasing_id()))

    def asked(kind: int, name: str) -> DataFrame:
        return (first.select("row", F.explode(F.arrays_zip(F.col(name).alias("key"), F.col(f"{name}_n").alias("c"))).alias("r"))
                .select("row", F.lit(kind).alias("kind"), F.col("r.key").alias("key"), F.col("r.c").alias("c")))

    rest = score_rest(grams, first.select(F.explode("gram").alias("key")), low)
    value = (words.filter(F.col("n") < least).select(F.lit(WORDS).alias("kind"), "key", F.log10(F.col("n") + 0.5).alias("log"))
             .unionByName(rest.select(F.lit(GRAMS).alias("kind"), "key", "log")))
    of_word = F.col("kind") == WORDS
    rare = (asked(WORDS, "word").unionByName(asked(GRAMS, "gram")).join(value, ["kind", "key"], "left")
            .groupBy("row").agg(F.sum(F.when(of_word, F.col("c") * F.coalesce("log", F.log10(F.lit(0.5))))).alias("more"),
                                F.sum(F.when(of_word & F.col("log").isNotNull(), F.col("c"))).alias("more_known"),
                                F.sum(F.when(~of_word, F.col("c") * F.col("log"))).alias("more_score")))
    return (first.drop("word", "word_n", "gram", "gram_n").join(rare, "row", "left")
            .select("doc_id", (crc_fold(F.col("doc_id")) == skip_fold).alias("held_out"), "n_tokens",
                    (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(bottom)).alias("base_score"),
                    (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score")))
