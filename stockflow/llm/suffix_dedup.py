"""Operator 2: removal of repeated 100-byte strings through suffix arrays.

A string of ``length`` bytes is dealt by its anchor: of the ``GRAM``-byte grams inside it, the one
with the smallest hash (leftmost of equals). Equal strings have equal anchors, so a repeated string
lies whole in one anchor's group, and neighbouring strings share an anchor: a stretch of starts with
one anchor is one segment. Anchors that occur once in the corpus hold no repeat; they are dropped
through a bit filter sized by the anchors that repeat (its false hits cost work, not results). Equal segments of a group
are summed to one with their earliest place before anything is sorted.

The distinct segments of many groups are joined to a text whose suffix array is built in two
stages: suffixes smaller than their successors are sorted directly, the others are induced by
scanning the buckets in ascending order. Adjacent common prefixes then cut the array into classes
of equal strings; the earliest place of a class stays, every other start is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import BitFilter, bit_filter, slices, text_bytes
from stockflow.session import cut_lineage

LENGTH, GRAM = 100, 32
#: Least bits of the filter of repeated anchors; it grows with their number.
FILTER_BITS = 2 ** 27
#: Bytes of segments in one suffix array; groups with more distinct segments than GROUP_KINDS are
#: split by their strings instead.
ARRAY_BYTES, GROUP_KINDS = 4 << 20, 20_000
#: Bytes of text hashed together.
BUFFER = 1 << 18

_TABLE = np.random.default_rng(1).integers(1, 2 ** 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
_LOW = np.uint64((1 << 31) - 1)
LAST_ID = (1 << 63) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_hashes(a: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` (a power of two) bytes, by doubling."""
    h, width, power = _TABLE[a], 1, _BASE
    with np.errstate(over="ignore"):
        while width < size:
            h = h[:-width] * power + h[width:]
            power, width = power * power, 2 * width
    return _mixed(h)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    w = 1
    while 2 * w <= width:
        v = np.minimum(v[:-w], v[w:])
        w *= 2
    return np.minimum(v[:-(width - w)], v[width - w:]) if width > w else v


def segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per buffer of texts: text number, first start, number of starts, anchor hash, segment hash."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BUFFER):
            size += len(texts[end])
            end += 1
        part = texts[at:end]
        lens = np.fromiter(map(len, part), np.int64, len(part))
        if size >= length and (lens >= length).any():
            a = np.frombuffer(b"".join(part), np.uint8)
            h = gram_hashes(a, GRAM)
            least = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
            first = np.cumsum(lens) - lens
            inside = np.zeros(len(least) + 1, np.int64)
            big = lens >= length
            np.add.at(inside, first[big], 1)
            np.add.at(inside, (first + lens - length + 1)[big], -1)
            starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
            owner = np.searchsorted(first, starts, side="right") - 1
            v = least[starts]
            head = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (owner[1:] != owner[:-1])])
            n = np.diff(np.append(head, len(starts)))
            lo, anchor, doc = starts[head], (v[head] & _LOW).astype(np.int64), owner[head]
            with np.errstate(over="ignore"):
                up = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(a), _BASE)))
                down = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(a), _UNBASE)))
                total = np.append(np.uint64(0), np.cumsum(_TABLE[a] * up[:-1]))
                seg = _mixed((total[lo + n + length - 1] - total[lo]) * down[lo])
                seg = _mixed(seg + (anchor - lo).astype(np.uint64) * _BASE + n.astype(np.uint64))
            yield doc + at, lo - first[doc], n, h[anchor].view(np.int64), seg.view(np.int64)
        at = end


def _repeated_anchors(docs: DataFrame, text_col: str, length: int) -> BitFilter:
    """The hashes of the anchors that occur more than once in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.minimum(n, 2).astype(np.int8))], names=["h", "n"])

        for b in slices(batches, 1000):
            for *_, h, _ in segments(text_bytes(b.column(0)), length):
                held.append(h)
                size += len(h)
            if size > 2_000_000:
                yield out()
                size = 0
        yield out()

    twice = cut_lineage(docs.select(text_col).mapInArrow(run, "h long, n byte").groupBy("h").agg(F.sum("n").alias("n"))
                        .filter("n > 1").select("h"))
    return bit_filter(twice, FILTER_BITS)


def _places(docs: DataFrame, text_col: str, repeated: BitFilter, length: int) -> DataFrame:
    """Segments whose anchor may repeat: ``h``, ``seg``, ``doc``, ``row``, ``lo``, ``n``."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            ids, rows = b.column(0).to_numpy(), b.column(1).to_numpy()
            for doc, lo, n, h, seg in segments(text_bytes(b.column(2)), length):
                ok = np.flatnonzero(shared.value.holds(h.view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[ok]), pa.array(seg[ok]), pa.array(ids[doc[ok]]), pa.array(rows[doc[ok]]), pa.array(lo[ok]),
                     pa.array(n[ok].astype(np.int32))],
                    names=["h", "seg", "doc", "row", "lo", "n"])

    return docs.select("doc", "row", text_col).mapInArrow(run, "h long, seg long, doc long, row long, lo long, n int")


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes' first ``depth`` symbols, in two stages.

    ``text`` holds symbols from 1 with zeros between its parts; each wanted position has ``depth``
    symbols before the next zero. Suffixes smaller than their successors are sorted directly, as
    far as a wanted suffix or the induction of one needs them; then the buckets are scanned in
    ascending order and each suffix hands its larger predecessor to the end of the front of the
    predecessor's bucket.
    """
    n = len(text)
    step = np.sign(np.append(text[1:].astype(np.int16), -1) - text.astype(np.int16))
    # equal neighbours take the type of what follows them
    turn = np.flatnonzero(step)
    smaller = step[turn[np.minimum(np.searchsorted(turn, np.arange(n)), len(turn) - 1)]] > 0
    smaller[text == 0] = True                                  # zeros start the scan
    # a chain of induced suffixes ends at the next directly sorted one
    direct = np.flatnonzero(smaller)
    ends = direct[np.searchsorted(direct, wanted)]
    need = np.zeros(n + 1, np.int32)
    np.add.at(need, wanted, 1)
    np.add.at(need, ends + 1, -1)
    need = np.cumsum(need[:-1]) > 0
    sort = np.flatnonzero(need & smaller & (text > 0))
    padded = np.append(text - (text > 0), np.zeros(depth, text.dtype)).astype(np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    order = np.argsort(np.ascontiguousarray(rows[sort]).view(f"S{depth}").ravel(), kind="stable")
    sort = sort[order]
    own = np.searchsorted(text[sort], np.arange(text.max() + 2))    # sorted by first symbol already
    fronts: list[list[np.ndarray]] = [[] for _ in range(int(text.max()) + 1)]
    out = []
    for c in range(len(fronts)):
        if c == 0:
            bucket = np.flatnonzero(need & (text == 0))
        else:
            front = [np.concatenate(fronts[c])] if fronts[c] else []
            while front and len(front[-1]):                    # runs of the bucket's own symbol
                j = front[-1] - 1
                j = j[j >= 0]
                front.append(j[(text[j] == c) & need[j]])
            bucket = np.concatenate([*front, sort[own[c]:own[c + 1]]])
        out.append(bucket)
        j = bucket - 1
        j = j[j >= 0]
        j = j[(text[j] > c) & need[j]]
        if len(j):
            by = np.argsort(text[j], kind="stable")
            j = j[by]
            for part in np.split(j, np.flatnonzero(np.diff(text[j])) + 1):
                fronts[int(text[part[0]])].append(part)
    flag = np.zeros(n, bool)
    flag[wanted] = True
    sa = np.concatenate(out)
    return sa[flag[sa]]


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int, step: int = 100_000) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in the array, up to ``depth``."""
    rows = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(depth, text.dtype)), depth)
    out = np.zeros(len(sa), np.int64)
    for a in range(1, len(sa), step):
        same = rows[sa[a:a + step]] == rows[sa[a - 1:a - 1 + len(sa[a:a + step])]]
        out[a:a + step] = np.where(same.all(1), depth, same.argmin(1))
    return out


def repeated_starts(parts: list[bytes], doc: np.ndarray, lo: np.ndarray, n: np.ndarray, length: int):
    """Starts (part, offset) of the parts whose string also starts earlier in some part."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + 1
    first = np.cumsum(sizes + 1) - sizes - 1
    raw[first + sizes] = 0
    part = np.repeat(np.arange(len(parts)), n)
    off = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    wanted = first[part] + off
    sa = suffix_array(raw, wanted, length)
    new = common_prefixes(raw, sa, length) < length
    new[0] = True
    place = np.empty(len(raw), np.int64)
    place[wanted] = np.arange(len(wanted))
    k = place[sa]
    rank = np.empty(len(wanted), np.int64)
    start, owner = lo[part] + off, doc[part]
    by = np.lexsort((start, owner))                          # equal places rank alike
    rank[by] = np.cumsum(np.r_[False, (start[by][1:] != start[by][:-1]) | (owner[by][1:] != owner[by][:-1])])
    heads = np.flatnonzero(new)
    low = np.minimum.reduceat(rank[k], heads)
    late = rank[k] > np.repeat(low, np.diff(np.append(heads, len(k))))
    k = np.sort(k[late])
    return part[k], off[k]


def _sorted_marks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc, row, lo, n, text) sorted by h; whole groups share suffix arrays."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush(t: pa.Table) -> pa.RecordBatch:
        doc, lo, n = (t[c].to_numpy() for c in ("doc", "lo", "n"))
        part, off = repeated_starts([bytes(x) for x in t["text"].to_pylist()], doc, lo, n.astype(np.int64), length)
        head = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (off[1:] != off[:-1] + 1)]) if len(part) else np.zeros(0, int)
        last = np.append(head[1:], len(part)) - 1 if len(part) else head
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[part[head]]), pa.array(t["row"].to_numpy()[part[head]]), pa.array(lo[part[head]]),
             pa.array(lo[part[head]] + off[head]), pa.array(lo[part[head]] + off[last])],
            names=["doc", "row", "lo", "a", "b"])

    for b in batches:
        held.append(b)
        size += b.column(5).nbytes
        if size > ARRAY_BYTES:
            t = pa.Table.from_batches(held)
            h = t["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1]))                 # the last group may go on
            if cut:
                yield flush(t.slice(0, cut))
                held = t.slice(cut).combine_chunks().to_batches()
                size = sum(x.column(5).nbytes for x in held)
    if held:
        t = pa.Table.from_batches(held)
        if t.num_rows:
            yield flush(t)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   group_kinds: int = GROUP_KINDS) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Texts are UTF-8 bytes; earlier means a smaller id, or the same id and an earlier start; strings
    are judged on the input. Returns one row per input row: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` (of the remaining bytes), ``kept`` (those
    bytes).

    Null and empty texts, and texts below ``length`` bytes, lose nothing. Null ids come after all
    others, as one document (the largest long counts as null). Among rows that share an id the
    start alone decides which string is earlier, so exact repeats of a row neither remove one
    another nor differ in result, and any of them removes from others; each row loses only what
    its own text repeats. A row is known by its id and a 64-bit hash of its text. Other columns are ignored; an empty
    table gives no rows.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.select("doc", F.xxhash64("text").alias("row"), "text")
    places = cut_lineage(_places(base, "text", _repeated_anchors(base, "text", length), length))
    kinds = places.groupBy("h", "seg").agg(
        F.min(F.struct("doc", "lo", "row")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    groups = kinds.groupBy("h").agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("kinds"))
    kinds = cut_lineage(kinds.join(groups.filter("_all > 1").withColumnRenamed("h", "_h"), F.col("h") == F.col("_h"))
                        .select("h", "seg", F.col("first.doc").alias("doc"), F.col("first.row").alias("row"), F.col("first.lo").alias("lo"),
                                "n", "copies", "kinds"))
    # all but the earliest of equal segments go whole
    repeats = kinds.filter("copies > 1").select(
        F.col("h").alias("_h"), F.col("seg").alias("_s"), F.col("doc").alias("_d"), F.col("row").alias("_r"), F.col("lo").alias("_lo"))
    copies = places.join(repeats, (F.col("h") == F.col("_h")) & (F.col("seg") == F.col("_s")))
    level = (F.col("doc") == F.col("_d")) & (F.col("lo") == F.col("_lo"))
    later = copies.filter(~level).select("doc", "row", F.col("lo").alias("a"), (F.col("lo") + F.col("n") - 1).alias("b"))

    # the earliest of each, with its bytes
    asked = (kinds.groupBy("doc", "row").agg(F.collect_list(F.struct("h", "lo", "n", "kinds")).alias("want"))
             .withColumnsRenamed({"doc": "_doc", "row": "_row"}))
    own = (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row"))
    # exact repeats of a row meet in the join, one of them is cut
    cut = (base.join(asked, own).groupBy("doc", "row").agg(F.first("text").cast("binary").alias("t"), F.first("want").alias("want"))
           .select("doc", "row", "t", F.explode("want").alias("w"))
           .select("doc", "row", F.col("w.h").alias("h"), F.col("w.lo").alias("lo"), F.col("w.n").alias("n"), F.col("w.kinds").alias("kinds"),
                   F.substring("t", (F.col("w.lo") + 1).cast("int"), F.col("w.n") + F.lit(length - 1)).alias("text")))
    crowded = (kinds.agg(F.max("kinds")).first()[0] or 0) > group_kinds
    plain = cut.filter(F.col("kinds") <= group_kinds) if crowded else cut
    marks = (plain.select("h", "doc", "row", "lo", "n", "text").repartition("h").sortWithinPartitions("h")
             .mapInArrow(lambda it: _sorted_marks(it, length), "doc long, row long, lo long, a long, b long"))
    if crowded:                # a group with very many contexts: its strings are the keys
        strings = (cut.filter(F.col("kinds") > group_kinds)
                   .select("doc", "row", "lo", "text", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
                   .select("doc", "row", "lo", (F.col("lo") + F.col("o")).alias("a"), F.substring("text", F.col("o") + 1, F.lit(length)).alias("s")))
        firsts = strings.groupBy("s").agg(F.min(F.struct("doc", "a")).alias("first")).withColumnRenamed("s", "_s")
        marks = marks.unionByName(
            strings.join(firsts, F.col("s") == F.col("_s")).filter(F.struct("doc", "a") != F.col("first"))
            .select("doc", "row", "lo", "a", F.col("a").alias("b")))
    if base.groupBy("doc").agg((F.min("row") != F.max("row")).alias("_m")).filter("_m").limit(1).count():
        # other texts of an id that hold a cut segment at the same start share its marks
        marks = cut_lineage(marks)
        shared = marks.select(*(F.col(c).alias(f"_m{c}") for c in marks.columns))
        tied = (copies.filter(level & (F.col("row") != F.col("_r"))).select("doc", "row", "lo", "_r").distinct()
                .join(shared, (F.col("doc") == F.col("_mdoc")) & (F.col("_r") == F.col("_mrow")) & (F.col("lo") == F.col("_mlo"))))
        later = later.unionByName(tied.select("doc", "row", F.col("_ma").alias("a"), F.col("_mb").alias("b")))
    removed = (marks.drop("lo").unionByName(later).groupBy("doc", "row").agg(F.collect_set(F.struct("a", "b")).alias("marks"))
               .withColumnsRenamed({"doc": "_doc", "row": "_row"}))
    # the same columns by the same key as above: one exchange of the texts serves both joins
    rows = base.join(removed, own, "left").select("doc", "text", "marks")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            out = []
            for t, m in zip(text_bytes(b.column(1)), _lists(b.column(2))):
                covered = np.zeros(len(t) + 1, np.int32)
                if len(t) >= length and len(m):
                    m = m[m[:, 0] <= len(t) - length]
                    np.add.at(covered, m[:, 0], 1)
                    np.add.at(covered, np.minimum(m[:, 1] + length, len(t)), -1)
                gone = np.cumsum(covered[:-1]) > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes() if spans else t
                out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [_given_ids(b.column(0)), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3]), pa.array(cols[4], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _given_ids(column: pa.Array) -> pa.Array:
    """Ids as given: the last of all stands for null."""
    ids = column.to_numpy()
    return pa.array(ids, mask=ids == LAST_ID)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Each row's pairs as an array; null is none."""
    for i in range(len(column)):
        x = column[i].values
        if x is None or not len(x):
            yield np.zeros((0, 2), np.int64)
        else:
            yield np.stack([x.field(0).to_numpy(), x.field(1).to_numpy()], 1)
