"""Operator 13: phrase collocations by sampling with a checked negative border (Toivonen).

A sample of the documents, mined at a lowered threshold, proposes phrases. The full pass then counts
exactly all words, all proposals and their negative border: every phrase that is not proposed but
whose first part and last part (all but its last, or first, word) are. A border phrase that reaches the
threshold shows that the proposals were short of it. Any frequent phrase not counted yet contains such
a failure: of its parts that are not proposed, the shortest has proposed parts, so it was on the
border, and is frequent with the whole. So an expansion pass counts all phrases around the failures, up to
their full length, and closes the border: every frequent phrase has then been counted, whatever the
sample was.

The border is long and hardly any of it frequent, so the full pass first adds up 64-bit phrase
hashes; only phrases whose hash reaches the threshold are then counted by their words.

Sets of phrases travel as bit filters of bounded size. A bit set by chance only puts more phrases
on the border, which are counted as exactly as the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import MIN_BITS, BitFilter, bit_filter
from stockflow.session import cut_lineage

#: Characters that end a piece, blanks between words, and upper case letters folded.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
FOLD = bytes.maketrans(PIECE_ENDS + b"\t" + bytes(range(65, 91)), b"\n" * len(PIECE_ENDS) + b" " + bytes(range(97, 123)))
NO_LANG = "und"

#: One document in so many is sampled, and the part of a phrase's fair share that proposes it.
SAMPLE_ONE_IN, SAMPLE_EASE = 8, 0.5
#: Words that a task gathers before it counts them.
GATHER = 3_000_000
#: A key that holds this part of a join's rows is looked up in a broadcast: there are at most so many.
HEAVY_PARTS = 4096
#: Ways a language is dealt for its best phrases.
TOP_PARTS = 256

LONGEST = 4
W = [f"w{k}" for k in range(1, LONGEST + 1)]
GRAM = ["lang", *W]
PHRASES = "lang string, " + ", ".join(f"{w} long" for w in W)
COUNTED = PHRASES + ", word string, n long"

MIX = np.uint64(0x9E3779B97F4A7C15)
PIECE_END = np.uint64(1)


#: Bytes of text hashed together; longer texts are hashed as one.
BUFFER = 1 << 20


class WordHash:
    """64-bit hashes of all words of a buffer at once: a polynomial over random numbers of the bytes.

    Sums over a buffer's prefixes, weighed by powers of an odd base, give each word's polynomial by a
    difference and an inverse power.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng([seed, 13])
        self.table = rng.integers(1, 2 ** 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1, 2 ** 62)) * 4 + 3
        self.up = self.down = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, BUFFER)
            ones = np.ones(1, np.uint64)
            self.up, self.down = (np.multiply.accumulate(np.append(ones, np.full(n - 1, np.uint64(b))))
                                  for b in (self.base, pow(self.base, -1, 2 ** 64)))

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
        self._powers(len(buf))
        total = np.append(np.zeros(1, np.uint64), np.cumsum(self.table[buf] * self.up[:len(buf)], dtype=np.uint64))
        x = (total[ends] - total[starts]) * self.down[starts] + np.uint64(salt)
        x ^= x >> np.uint64(32)
        x *= MIX
        x ^= x >> np.uint64(29)
        return np.maximum(x, np.uint64(2))          # 0 is no word and 1 the end of a piece


def lang_salt(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a folded buffer (blanks are spaces, pieces end at newlines, as
    does the buffer), and for each word and piece end in order whether it is a word."""
    end = buf == 10
    gap = end | (buf == 32)
    word = ~gap
    first = word.copy()
    first[1:] &= gap[:-1]
    last = word[:-1] & gap[1:]
    event = np.flatnonzero(first | end)
    return np.flatnonzero(first), np.flatnonzero(last) + 1, ~end[event]


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its first part and its last part."""
    x = (a * MIX) ^ ((b << np.uint64(31)) | (b >> np.uint64(33)))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def border_grams(h: np.ndarray, proposed: BitFilter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1 to LONGEST: phrase hashes at all places of the word stream, and which of them
    have a proposed first and last part (all words, for length 1)."""
    phrase, ok = h, h > PIECE_END
    yield phrase, ok
    for _ in range(2, LONGEST + 1):
        in_set = ok & proposed.holds(phrase)
        phrase, ok = join_hash(phrase[:-1], phrase[1:]), in_set[:-1] & in_set[1:]
        yield phrase, ok


class Streams:
    """Word hash streams of batches of documents, by language, gathered to some size. With ``spelled``
    a second hash and the text of every word are kept too."""

    def __init__(self, seed: int, spelled: bool = False):
        self.first, self.second, self.spelled, self.size = WordHash(2 * seed), WordHash(2 * seed + 1), spelled, 0
        self.held: dict[str, list[tuple]] = {}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, tuple | None]]:
        for b in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for part in _buffers(texts):
                    self._add(lang, part)
                    if self.size >= GATHER:
                        yield from self._flush()
        yield from self._flush()

    def _add(self, lang: str, text: bytes) -> None:
        folded = text.translate(FOLD)
        buf = np.frombuffer(folded, np.uint8)
        starts, ends, is_word = word_bounds(buf)
        salt = lang_salt(lang)
        words = self.first(buf, starts, ends, salt)
        stream = np.full(len(is_word), PIECE_END)
        stream[is_word] = words
        more = None
        if self.spelled:        # one row a word of the buffer: hashes, count, and its text
            _, at, back, n = np.unique(words, return_index=True, return_inverse=True, return_counts=True)
            check = self.second(buf, starts, ends, salt)
            odd = np.flatnonzero(check != check[at][back])          # another word of the same hash
            at, n = np.append(at, odd), np.append(n, np.zeros(len(odd), n.dtype))
            more = (words[at], check[at], n, [folded[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())])
        self.held.setdefault(lang, []).append((stream, more))
        self.size += len(stream)

    def _flush(self) -> Iterator[tuple[str, np.ndarray, tuple | None]]:
        for lang in list(self.held):
            parts = self.held.pop(lang)
            spelled = None
            if self.spelled:
                h, check, n = (np.concatenate([m[k] for _, m in parts]) for k in range(3))
                texts = [t for _, m in parts for t in m[3]]
                order = np.lexsort((check, h))
                h, check, n = h[order], check[order], n[order]
                head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])])) if len(h) else order
                spelled = (h[head], np.add.reduceat(n, head) if len(h) else n, [texts[i] for i in order[head].tolist()])
            yield lang, np.concatenate([x for x, _ in parts]), spelled
        self.size = 0


def _buffers(texts: list[bytes]) -> Iterator[bytes]:
    """Texts joined to buffers, each text ended like a piece."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) >= BUFFER:
            yield b"\n".join([*part, b""])
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield b"\n".join([*part, b""])


def frequent_hashes(docs: DataFrame, proposed: BitFilter, lengths: list[int], at_least: int, seed: int) -> DataFrame:
    """Hashes ``h`` of the phrases of the given lengths, proposed or on the border, that reach the
    threshold (phrases that share a hash together)."""
    shared = docs.sparkSession.sparkContext.broadcast(proposed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, _ in Streams(seed)(batches):
            for n, (phrase, ok) in enumerate(border_grams(h, shared.value), 1):
                if n not in lengths:
                    continue
                kinds, times = np.unique(phrase[ok], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], names=["h", "n"])

    # a task's counts are summed already: dealt by hash as they are, one row a hash and gathered stream
    return (docs.mapInArrow(run, "h long, n long").repartition("h").groupBy("h").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= at_least).select("h"))


def exact_counts(docs: DataFrame, choose, filters: tuple[BitFilter, ...], seed: int, words: bool) -> DataFrame:
    """Exact counts (``lang``, words, ``n``) of the phrases at the places that ``choose(h, *filters)``
    names, and with ``words`` of all words, with their text."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, h, spelled in Streams(seed, words)(batches):
            def rows(grams: np.ndarray, times: np.ndarray, word: pa.Array) -> pa.RecordBatch:
                cols = [np.ascontiguousarray(grams[:, k]).view(np.int64) if k < grams.shape[1] else np.zeros(len(times), np.int64)
                        for k in range(LONGEST)]
                return pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(times)), *map(pa.array, cols), word, pa.array(times.astype(np.int64))],
                    names=[*GRAM, "word", "n"])

            if words:           # by their text, so that two words of one hash are two rows
                kinds, times, texts = spelled
                yield rows(kinds[:, None], times, pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()))
            for n, (phrase, ok) in enumerate(choose(h, *shared.value), 1):
                at = np.flatnonzero(ok)
                if n == 1 or len(at) == 0:
                    continue
                # equal phrases lie together, unless hashes collide: then in several runs
                at = at[np.argsort(phrase[at])]
                grams = np.stack([h[at + k] for k in range(n)], 1)
                first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]).any(1)]))
                yield rows(grams[first], np.diff(np.append(first, len(at))), pa.nulls(len(first), pa.string()))

    return docs.mapInArrow(run, COUNTED).groupBy(*GRAM, "word").agg(F.sum("n").alias("n"))


def on_border(h: np.ndarray, proposed: BitFilter, heavy: BitFilter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The proposed and border phrases whose hash reaches the threshold."""
    for phrase, ok in border_grams(h, proposed):
        yield phrase, ok & heavy.holds(phrase)


def beyond_border(h: np.ndarray, proposed: BitFilter, failed: BitFilter, frequent: BitFilter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The phrases that contain a failed phrase and were not on the border, less those with a part
    that is known to be infrequent: a word or counted phrase that is not among the frequent ones."""
    hopeful = (h > PIECE_END) & frequent.holds(h)
    inside = hopeful & failed.holds(h)
    for n, (phrase, was) in enumerate(border_grams(h, proposed), 1):
        if n == 1:
            yield phrase, np.zeros(len(h), bool)
            continue
        parts = hopeful[:-1] & hopeful[1:]
        hopeful = parts & (~was | frequent.holds(phrase))
        inside = parts & (inside[:-1] | inside[1:] | failed.holds(phrase))
        yield phrase, inside & ~was


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    """Phrase hashes of the rows of a batch of phrases."""
    cols = [batch.column(batch.schema.get_field_index(w)).to_numpy(zero_copy_only=False).view(np.uint64) for w in W]
    length = sum((c != 0).astype(int) for c in cols)
    level, out = cols, cols[0].copy()
    for n in range(2, LONGEST + 1):
        level = [join_hash(a, b) for a, b in zip(level[:-1], level[1:])]
        out = np.where(length == n, level[0], out)
    return out


def phrase_hashes(phrases: DataFrame, unless: BitFilter | None = None) -> DataFrame:
    """Hashes ``h`` of phrases, without those that ``unless`` holds."""
    shared = phrases.sparkSession.sparkContext.broadcast(unless)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _hashes(b)
            if shared.value is not None:
                h = h[~shared.value.holds(h)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return phrases.select(*W).mapInArrow(run, "h long")


def sample_proposals(sample: DataFrame, at_least: int, seed: int) -> BitFilter:
    """Phrases of up to LONGEST - 1 words that reach the lowered threshold in the sample, found one
    length at a time (longer ones are part of no other)."""
    known, proposed = None, BitFilter(MIN_BITS)
    for n in range(1, LONGEST):
        level = cut_lineage(frequent_hashes(sample, proposed, [n], at_least, seed))
        known = level if known is None else known.unionByName(level)
        proposed = bit_filter(known)
    return proposed


def mine(docs: DataFrame, at_least: int, proposed: BitFilter, seed: int) -> DataFrame | None:
    """All words, and every phrase of at least ``at_least`` occurrences, with exact counts, from any
    proposals. None if two different words have one hash."""
    heavy = bit_filter(cut_lineage(frequent_hashes(docs, proposed, list(range(2, LONGEST + 1)), at_least, seed)))
    counted = exact_counts(docs, on_border, (proposed, heavy), seed, True)
    enough = F.col("n") >= at_least
    found = cut_lineage(counted.filter(enough | F.col("word").isNotNull()))
    words = found.filter("word is not null")
    if not words.groupBy("w1").count().filter("count > 1").isEmpty():
        return None
    # a phrase of full length is part of no other: only shorter ones fail the border
    failed = cut_lineage(phrase_hashes(found.filter(enough & (F.col(W[-1]) == 0)), unless=proposed))
    if failed.isEmpty():
        return found
    frequent = bit_filter(phrase_hashes(found.filter(enough & (F.col(W[-1]) == 0))))
    more = exact_counts(docs, beyond_border, (proposed, bit_filter(failed), frequent), seed, False)
    return found.unionByName(cut_lineage(more.filter(enough)))


def lookup(rows: DataFrame, keys: list[str], table: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with a table of one row a key, however many rows share a key: keys that
    hold 1 / HEAVY_PARTS of the rows, so at most HEAVY_PARTS of them, are looked up in a broadcast."""
    total = rows.count()
    heavy = cut_lineage(rows.groupBy(*keys).count().filter(F.col("count") * HEAVY_PARTS >= total).select(*keys))
    few = F.broadcast(table.join(F.broadcast(heavy), keys, "left_semi"))
    return rows.join(few, keys).unionByName(
        rows.join(F.broadcast(heavy), keys, "left_anti").join(table, keys))


def _part(first: int, n: int) -> list[F.Column]:
    """The ``n`` words from number ``first`` on as the columns of a phrase."""
    return [(F.col(W[first + k]) if k < n else F.lit(0).cast("long")).alias(W[k]) for k in range(LONGEST)]


def _parts(phrases: DataFrame, parts: list[tuple[int, int, int, int]], *keep: str) -> DataFrame:
    """One row for each phrase of length ``n`` and each of its parts (n, first word, words, slot)."""
    cells = [F.when(F.col("len") == n, F.struct(F.lit(slot).alias("slot"), *_part(first, m))) for n, first, m, slot in parts]
    return (phrases.select("lang", *keep, F.explode(F.array_compact(F.array(*cells))).alias("p"))
            .select("lang", *keep, "p.*"))


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                      at_least: int = 30, top: int = 2000, scale: int = 2_000_000, covered: int = 80,
                      one_in: int = SAMPLE_ONE_IN, seed: int = 0) -> DataFrame:
    """The best collocations of two to four words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at
    blanks. Phrases of ``at_least`` occurrences in their language are scored by the cut into two
    parts that explains them best: ``floor(scale * a / (l + r))``, the lowest of all cuts. Phrases
    inside a longer one that has ``covered`` percent of their occurrences are dropped.

    Returns ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (its count), ``l``, ``r`` (those of the parts),
    ``n`` (words of the language) and ``score``; the first ``top`` of each language by score, count
    (descending) and phrase. All counts are exact, over all documents.

    Null texts are empty; a null language is ``und``, as is that name. Repeated rows and ids count
    each. Other columns are ignored; an empty table gives no rows.
    """
    text, lang = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    rows = docs.select(lang.alias("lang"), text.alias("text"))
    chosen = F.pmod(F.coalesce(F.xxhash64(F.col(id_col)), F.xxhash64(text)), F.lit(one_in)) == 0
    sample = docs.filter(chosen).select(lang.alias("lang"), text.alias("text"))
    ease = max(2, int(at_least / one_in * SAMPLE_EASE))
    found = None
    while found is None:
        found = mine(rows, at_least, sample_proposals(sample, ease, seed), seed)
        seed += 1

    words = found.filter("word is not null")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("words"))
    length = sum((F.col(w) != 0).cast("int") for w in W)
    known = cut_lineage(found.filter(F.col("n") >= at_least).groupBy(*GRAM).agg(F.max("n").alias("n"))
                        .withColumn("len", length).withColumn("cid", F.monotonically_increasing_id()))
    counts = known.select(*GRAM, F.col("n").alias("m"))
    phrases = known.filter("len > 1")

    cuts = [(n, first, m, 2 * (k - 1) + side) for n in range(2, LONGEST + 1) for k in range(1, n)
            for side, first, m in ((0, 0, k), (1, k, n - k))]
    sides = (lookup(_parts(phrases, cuts, "cid"), GRAM, counts).groupBy("cid")
             .agg(*[F.max(F.when(F.col("slot") == s, F.col("m"))).alias(f"m{s}") for s in range(2 * LONGEST - 2)]))
    value = [F.expr(f"(cast(n as decimal(20,0)) * {int(scale)}) div (cast(m{2 * k} as decimal(20,0)) + m{2 * k + 1})")
             for k in range(LONGEST - 1)]
    best = F.array_min(F.array_compact(F.array(*[
        F.when(F.col(f"m{2 * k}").isNotNull(), F.struct(v.alias("score"), F.lit(k).alias("k"), F.col(f"m{2 * k}").alias("l"),
                                                        F.col(f"m{2 * k + 1}").alias("r"))) for k, v in enumerate(value)])))

    inner = [(n, first, m, 0) for n in range(3, LONGEST + 1) for m in range(2, n) for first in range(n - m + 1)]
    longer = _parts(phrases, inner, "n").groupBy(*GRAM).agg(F.max("n").alias("longest"))
    scored = (phrases.join(longer, GRAM, "left")
              .filter(F.col("longest").isNull() | F.expr(f"cast(longest as decimal(20,0)) * 100 < cast(n as decimal(20,0)) * {int(covered)}"))
              .join(sides, "cid").withColumn("best", best)
              .select("cid", *GRAM, F.col("n").alias("a"), "best.score", "best.l", "best.r"))

    part = F.pmod(F.xxhash64("cid"), F.lit(TOP_PARTS)).alias("part")
    order = [F.desc("score"), F.desc("a")]
    some = cut_lineage(scored.withColumn("part", part)
                       .withColumn("_k", F.rank().over(Window.partitionBy("lang", "part").orderBy(*order)))
                       .filter(F.col("_k") <= top).drop("_k"))
    ahead = Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    level = (some.groupBy("lang", "score", "a").count()
             .withColumn("_b", F.coalesce(F.sum("count").over(ahead), F.lit(0))).filter(F.col("_b") < top)
             .select("lang", "score", "a"))
    some = cut_lineage(some.join(level, ["lang", "score", "a"]))
    spelled = some.select("lang", "cid", F.posexplode(F.array(*W)).alias("at", "w1")).filter("w1 <> 0")
    names = (lookup(spelled, ["lang", "w1"], words.filter(F.col("n") >= at_least).select("lang", "w1", "word")).groupBy("cid")
             .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("x"))
             .select("cid", F.array_join(F.transform("x", lambda y: y["word"]), " ").alias("phrase")))
    named = some.join(names, "cid")
    order = [*order, F.asc("phrase")]
    for key in (["lang", "part"], ["lang"]):
        named = (named.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
                 .filter(F.col("rank") <= top))
    return named.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            F.col("words").alias("n"), "score")


SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^ 	]+') as ws from p),
i as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from w),
g as (select lang, list_slice(ws, i, i + k - 1) as g from i, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(ws)),
f as (select lang, g, cast(count(*) as hugeint) as f from g group by lang, g having count(*) >= 30),
n as (select lang, cast(count(*) as bigint) as n from i group by lang),
c as (select lang, g, f as a, unnest(range(1, len(g))) as k from f where len(g) > 1),
s as (
  select c.lang, c.g, c.a, c.k, x.f as l, y.f as r, 2000000 * c.a // (x.f + y.f) as score
  from c join f x on x.lang = c.lang and x.g = list_slice(c.g, 1, c.k)
  join f y on y.lang = c.lang and y.g = list_slice(c.g, c.k + 1, len(c.g))),
b as (select * from s qualify row_number() over (partition by lang, g order by score, k) = 1),
o as (
  select lang, list_slice(g, x, x + m - 1) as g, max(f) as longest
  from (select lang, g, f, m, unnest(range(1, len(g) - m + 2)) as x
        from (select lang, g, f, unnest(range(2, len(g))) as m from f where len(g) > 2)) group by 1, 2),
t as (
  select b.lang, array_to_string(b.g, ' ') as phrase, b.a, b.l, b.r, b.score
  from b left join o on o.lang = b.lang and o.g = b.g where o.longest is null or 100 * o.longest < 80 * b.a),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from t)
select r.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       n.n, cast(score as bigint) as score
from r join n on n.lang = r.lang where rank <= 2000
"""
