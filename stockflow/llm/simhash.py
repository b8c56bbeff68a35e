"""Operator 8: SimHash near-duplicates through sharded BK-trees.

Fingerprints that differ in at most ``radius`` bits agree on one of ``radius + 1`` bit blocks, so
distinct fingerprints are dealt into shards by (block, value) and a BK-tree is built in every
shard: children hang on their integer Hamming distance to the parent, and a search follows only
edges within the radius of the query's distance. A shard above ``SHARD_ROWS`` is dealt again by
the blocks of its remaining bits (the same argument), so no shard need hold a common block value
whole. Trees stay in the tasks of their shards rather than being broadcast: all fingerprints
together have no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import local_components, row_key, slices, text_bytes
from stockflow.llm.components import components
from stockflow.session import cut_lineage

#: Members of a shard above which it is dealt again by the blocks of its remaining bits.
SHARD_ROWS = 2048
#: Shard members whose trees are searched together in one call.
TREE_ROWS = 40_000
#: Query-node pairs examined at once.
PAIRS = 2_000_000


def fingerprint(words: list[bytes], shingle: int, seed: int = 42) -> int:
    """SimHash of a word list; no words give zero, too few words one shingle."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    h = np.array([digest(view[a:b], seed) for a, b in
                  zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, key_col: str | None = None) -> DataFrame:
    """``doc_id`` and the 64-bit fingerprint as a signed long ``fp``, and the string ``key`` if asked for."""
    extra = [] if key_col is None else [F.col(key_col).alias("key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            fp = np.array([fingerprint(t.lower().split(), shingle) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", "key"][:b.num_columns])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col), *extra).mapInArrow(
        run, "doc_id long, fp long" + (", key string" if extra else ""))


def blocks(n_bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``parts`` near-equal blocks over ``n_bits`` bits."""
    cuts = [n_bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def bk_links(fp: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius, inside each shard, by a BK-tree per shard.

    All trees grow and are searched level by level together: a cluster is the set of members
    under one node, its first member is the node, the others are dealt by their distance to it.
    Returns member numbers ``u``, ``v`` that span each group of linked members (not every pair:
    a member linked already through an earlier node of the level needs no second link).
    """
    n = len(fp)
    root = np.arange(n)
    u_all, v_all = [], []
    # tree: for each level the node of each cluster, and (cluster, distance) -> child cluster
    members, cluster = np.arange(n), np.unique(shard, return_inverse=True)[1]
    first_of_shard = cluster.copy()
    levels = []
    while len(members):
        order = np.argsort(cluster, kind="stable")
        members, cluster = members[order], cluster[order]
        head = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
        node = members[head]                       # clusters are numbered 0..len(node)-1
        dist = np.bitwise_count(fp[members] ^ fp[node[cluster]]).astype(np.int64)
        rest = np.ones(len(members), bool)
        rest[head] = False
        key = cluster[rest] * 65 + dist[rest]
        child_keys, child = np.unique(key, return_inverse=True)
        levels.append((node, child_keys))
        members, cluster = members[rest], child
    # search: every member of a shard against the shard's tree
    step = max(1, PAIRS // max(1, int(np.bincount(first_of_shard).max(initial=1))))
    by_shard = np.argsort(first_of_shard, kind="stable")
    for at in range(0, n, step):
        q = by_shard[at:at + step]
        c = first_of_shard[q]
        for node, child_keys in levels:
            if not len(q):
                break
            d = np.bitwise_count(fp[q] ^ fp[node[c]]).astype(np.int64)
            hit = (d <= radius) & (node[c] < q)
            u_all.append(q[hit])
            v_all.append(node[c[hit]])
            if not len(child_keys):
                break
            lo = np.searchsorted(child_keys, c * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(child_keys, c * 65 + np.minimum(d + radius, 64), side="right")
            width = hi - lo
            at_child = np.repeat(lo - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
            q, c = np.repeat(q, width), at_child
        if sum(map(len, u_all)) > PAIRS:           # links found so far shrink to a spanning star
            u, v = np.concatenate(u_all), np.concatenate(v_all)
            root = local_components(n, np.append(u, np.arange(n)), np.append(v, root))
            u_all, v_all = [], []
    u = np.concatenate([*u_all, np.arange(n)])
    v = np.concatenate([*v_all, root])
    root = local_components(n, u, v)
    far = np.flatnonzero(root != np.arange(n))
    return far, root[far]


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, fp) sorted by shard; whole shards are searched together."""
    held_s, held_f, held = [], [], 0

    def flush(s: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        u, v = bk_links(f.view(np.uint64), s, radius)
        return pa.RecordBatch.from_arrays([pa.array(f[u]), pa.array(f[v])], names=["u", "v"])

    for b in batches:
        s, f = b.column(0).to_numpy(), b.column(1).to_numpy()
        held_s.append(s)
        held_f.append(f)
        held += len(s)
        if held >= TREE_ROWS:
            s, f = np.concatenate(held_s), np.concatenate(held_f)
            open_from = int(np.searchsorted(s, s[-1]))   # the last shard may go on in the next batch
            if open_from:
                yield flush(s[:open_from], f[:open_from])
            held_s, held_f, held = [s[open_from:]], [f[open_from:]], len(s) - open_from
    if held:
        yield flush(np.concatenate(held_s), np.concatenate(held_f))


def _block_key(fp, first: int, width: int):
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def hamming_links(fps: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``u``, ``v`` that span all groups of distinct fingerprints ``fp`` within ``radius``."""
    first = blocks(64, radius + 1)
    keyed = fps.select("fp", F.posexplode(F.array(*[_block_key(F.col("fp"), a, w) for a, w in first]))
                       .alias("b", "val"))
    # a second block inside the rest of the bits, for shards that are too large
    inner = []
    for i, (a, w) in enumerate(first):
        rest = [x for x in range(64) if not a <= x < a + w]
        keys = []
        for p, (c, cw) in enumerate(blocks(len(rest), radius + 1)):
            mask = sum(1 << x for x in rest[c:c + cw])
            mask -= (mask >> 63) << 64
            keys.append(F.xxhash64(F.lit(p), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))))
        inner.append(F.array(*keys))
    sizes = keyed.groupBy("b", "val").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > shard_rows)
    sizes = sizes.select(F.col("b").alias("_b"), F.col("val").alias("_v"), "_n")
    sub = F.when(F.col("_n").isNull(), F.array(F.lit(0).cast("long")))
    for i, k in enumerate(inner):
        sub = sub.when(F.col("b") == i, k)
    shards = (keyed.join(sizes, (F.col("b") == F.col("_b")) & (F.col("val") == F.col("_v")), "left")
              .withColumn("_sub", F.explode(sub))
              .select(F.xxhash64("b", "val", "_sub").alias("shard"), "fp"))
    return (shards.repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(lambda it: _search(it, radius), "u long, v long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, radius: int = 4) -> DataFrame:
    """Fingerprint and near-duplicate group of every document.

    Returns one row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``
    (smallest id reachable over fingerprints that differ in at most ``radius`` bits).

    Equal fingerprints are one node, so copies of a text cost one node whatever their number.
    Null and empty texts have fingerprint zero and link like any other. Null ids take part but
    never name a group unless all its ids are null (then the group is null). Repeated rows are
    returned as often as given. Other columns are ignored; an empty table gives no rows.
    """
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = _rooted(nodes, radius)
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = named.join(lows, "root").select("fp", "component_id")
    return (marked.join(ids, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints ``fp`` and their ``low`` with the fingerprint ``root`` that names their group."""
    roots = components(hamming_links(nodes.select("fp"), radius))
    return (nodes.join(roots, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), "low"))


def keep_one(docs: DataFrame, groups: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each group, with the columns of ``docs``: that of the smallest id (null last).

    Of rows that share this id the smallest hash of text and columns decides. Groups are told
    apart by their fingerprints: ids may be null or repeat, so ``groups`` (the result of
    ``simhash_groups``) cannot tell them and is not read.
    """
    keyed = docs.withColumn("__key", row_key(text_col, *(c for c in docs.columns if c != text_col)))
    slim = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col("__key").alias("key"))
    marked = cut_lineage(fingerprints(slim, "doc_id", "text", shingle, "key"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    named = _rooted(marked.groupBy("fp").agg(F.min(order).alias("low")), radius)
    keep = named.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.key").alias("__keep"))
    # rows alike in all columns are one before they meet the join
    once = keyed.dropDuplicates(["__key"])
    return once.join(keep, F.col("__key") == F.col("__keep"), "left_semi").select(*docs.columns)
