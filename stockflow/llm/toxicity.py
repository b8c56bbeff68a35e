"""Operator 4: toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a word input (hashed embedding and the log-odds of its hash bucket among labelled
texts) and a character input (mean hashed embedding of its 5-grams and their largest log-odds).
Every text is scored over all its overlapping windows. Training takes a bounded sample of labelled
texts: of a toxic text its most telling window, of a clean one its most telling and another.
A text's score is its highest window logit, calibrated on texts that the network has not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import crc_fold, slices, text_bytes
from stockflow.session import cut_lineage

#: Labelled texts that the model is fitted on, at most, chosen by hash of the id; every fourth calibrates.
FIT_ROWS = 16_000
WINDOW, STRIDE = 32, 16
BUCKETS = 1 << 17
EMBED, HIDDEN = 8, 8
CHUNK = 4096
#: Bytes of a character gram, and texts' worth of the prior in the log-odds of a bucket.
GRAM, PRIOR = 5, 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The distinct words of a batch of texts with their hash buckets, and each text as word numbers."""

    def __init__(self, texts: list[bytes]):
        index: dict[bytes, int] = {b"": 0}                # number 0 pads
        number = lambda w: index.setdefault(w, len(index))
        self.docs = [np.array([number(w) for w in t.lower().split()], np.int64) for t in texts]
        words = list(index)
        self.word = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS
        buf = np.frombuffer(b"\n" + b"\n".join(words) + b"\n", np.uint8).astype(np.uint64)
        # grams over each word and one mark on either side; none crosses a mark
        n = max(0, len(buf) - GRAM + 1)
        key, inside = np.zeros(n, np.uint64), np.ones(n, bool)
        for i in range(GRAM):
            key = (key << np.uint64(8)) | buf[i:i + n]
            if 0 < i < GRAM - 1:
                inside &= buf[i:i + n] != 10
        at = np.flatnonzero(inside)
        self.gram = ((key[at] * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lens + 1) - lens - 1           # each word's leading mark
        self.first = np.searchsorted(at, starts)
        self.count = np.maximum(lens + 3 - GRAM, 0)

    def per_word(self, values: np.ndarray, how) -> np.ndarray:
        """Reduce values of the 5-grams to their words; words without any get zero."""
        out = np.zeros((len(self.word), *values.shape[1:]), values.dtype)
        some = np.flatnonzero(self.count)
        if len(some):
            out[some] = how.reduceat(values, self.first[some])
        return out


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows over ``n`` words; the last one reaches the end."""
    return np.arange(0, max(1, -(-(n - WINDOW) // STRIDE) + 1)) * STRIDE if n > WINDOW else np.zeros(1, np.int64)


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as word numbers, and the text of each."""
    starts = [window_starts(len(d)) for d in docs]
    flat = np.concatenate([np.append(d, np.zeros(WINDOW, np.int64)) for d in docs])
    base = np.cumsum([0] + [len(d) + WINDOW for d in docs[:-1]])
    doc = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    at = np.concatenate(starts) + base[doc]
    return flat[at[:, None] + np.arange(WINDOW)], doc


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class ToxicNet:
    """Parameters and passes. Gates are ordered update, reset, candidate."""

    def __init__(self, word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.word_odds, self.gram_odds = word_odds, gram_odds
        d, h = 2 + 2 * EMBED, HIDDEN
        f = lambda *s, by: rng.normal(0, by, s).astype(np.float32)
        self.p = {"ew": f(BUCKETS, EMBED, by=0.05), "ec": f(BUCKETS, EMBED, by=0.05)}
        for k in "fb":
            self.p |= {f"w{k}": f(d, 3 * h, by=d ** -0.5), f"u{k}": f(h, 3 * h, by=h ** -0.5),
                       f"c{k}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": f(2 * h, by=0.3), "o": f(2 * h, by=0.3), "s": np.zeros(1, np.float32)}
        self.scale, self.offset = 1.0, 0.0

    def inputs(self, w: Words) -> np.ndarray:
        """Input vector of each distinct word."""
        n = np.maximum(w.count, 1)[:, None]
        chars = w.per_word(self.p["ec"][w.gram], np.add) / n
        x = np.concatenate([self.word_odds[w.word][:, None], w.per_word(self.gram_odds[w.gram], np.maximum)[:, None],
                            self.p["ew"][w.word], chars], 1)
        x[0] = 0
        return x.astype(np.float32)

    def _run(self, gates: np.ndarray, k: str, keep: list | None = None) -> np.ndarray:
        """States after each step from the projected inputs (steps x rows x 3H), in step order."""
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        u, n = self.p[f"u{k}"], HIDDEN
        out = np.empty((len(gates), *h.shape), np.float32)
        for t in range(len(gates)):
            zr = _sigmoid(gates[t, :, :2 * n] + h @ u[:, :2 * n])
            z, r = zr[:, :n], zr[:, n:]
            c = np.tanh(gates[t, :, 2 * n:] + (r * h) @ u[:, 2 * n:])
            if keep is not None:
                keep.append((h, z, r, c))
            h = h + z * (c - h)
            out[t] = h
        return out

    def logits(self, w: Words, idx: np.ndarray) -> np.ndarray:
        """Logit of every window, in chunks."""
        x = self.inputs(w)
        proj = {k: x @ self.p[f"w{k}"] + self.p[f"c{k}"] for k in "fb"}
        out = np.empty(len(idx))
        for at in range(0, len(idx), CHUNK):
            i = idx[at:at + CHUNK].T
            hs = np.concatenate([self._run(proj["f"][i], "f"), self._run(proj["b"][i[::-1]], "b")[::-1]], 2)
            e = hs @ self.p["a"]
            e = np.exp(e - e.max(0))
            out[at:at + CHUNK] = (e * (hs @ self.p["o"])).sum(0) / e.sum(0) + self.p["s"][0]
        return out

    def step(self, w: Words, x: np.ndarray, idx: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the log loss over windows ``idx`` with labels ``y``."""
        i = idx.T
        g, kept, hs = {}, {}, []
        for k in "fb":
            j = i if k == "f" else i[::-1]
            kept[k] = []
            s = self._run(x[j] @ self.p[f"w{k}"] + self.p[f"c{k}"], k, kept[k])
            hs.append(s if k == "f" else s[::-1])
        hs = np.concatenate(hs, 2)
        e = hs @ self.p["a"]
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        v = hs @ self.p["o"]
        z = (alpha * v).sum(0)
        d = ((_sigmoid(z + self.p["s"][0]) - y) / len(y)).astype(np.float32)
        g["s"] = np.array([d.sum()], np.float32)
        g["o"] = np.einsum("tbh,tb->h", hs, alpha * d)
        de = alpha * (v - z) * d
        g["a"] = np.einsum("tbh,tb->h", hs, de)
        dh_all = (alpha * d)[..., None] * self.p["o"] + de[..., None] * self.p["a"]
        dx = np.zeros_like(x)
        n = HIDDEN
        for k, part in (("f", dh_all[:, :, :n]), ("b", dh_all[::-1, :, n:])):
            j = i if k == "f" else i[::-1]
            u = self.p[f"u{k}"]
            gu, gates = np.zeros_like(u), np.empty((len(i), len(y), 3 * n), np.float32)
            dh = np.zeros((len(y), n), np.float32)
            for t in range(len(i) - 1, -1, -1):
                h, zt, r, c = kept[k][t]
                dh = dh + part[t]
                dc = dh * zt * (1 - c * c)
                dz = dh * (c - h) * zt * (1 - zt)
                back = dc @ u[:, 2 * n:].T
                dr = back * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], 1)
                gu[:, :2 * n] += h.T @ dzr
                gu[:, 2 * n:] += (r * h).T @ dc
                gates[t] = np.concatenate([dzr, dc], 1)
                dh = dh * (1 - zt) + dzr @ u[:, :2 * n].T + back * r
            g[f"u{k}"], g[f"c{k}"] = gu, gates.sum((0, 1))
            g[f"w{k}"] = np.einsum("tbd,tbg->dg", x[j], gates)
            np.add.at(dx, j, gates @ self.p[f"w{k}"].T)
        dx[0] = 0
        # of the embeddings only the rows in use: one gradient per word and per gram
        g["ew"] = dx[:, 2:2 + EMBED]
        g["ec"] = (dx[:, 2 + EMBED:] / np.maximum(w.count, 1)[:, None]).repeat(w.count, axis=0)
        return g

    def probability(self, best: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip(self.scale * best + self.offset, -30, 30))


def train(texts: list[bytes], labels: np.ndarray, odds: tuple[np.ndarray, np.ndarray], steps: int = 700,
          batch: int = 96, rate: float = 0.01, seed: int = 5) -> ToxicNet:
    """Fit the network on windows (texts of ``WINDOW`` words) with Adam; embeddings move by plain steps."""
    net, rng = ToxicNet(*odds), np.random.default_rng(seed)
    pos, neg = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    small = [k for k in net.p if k not in ("ew", "ec")]
    m, v, t = {k: 0.0 for k in small}, {k: 0.0 for k in small}, 0
    for _ in range(steps):
        pick = np.concatenate([rng.choice(pos, batch // 2), rng.choice(neg, batch // 2)])
        w = Words([texts[i] for i in pick])
        idx, doc = windows([d[:WINDOW] for d in w.docs])
        g = net.step(w, net.inputs(w), idx, labels[pick][doc].astype(np.float32))
        t += 1
        for k in small:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            net.p[k] -= rate * (1 - t / (steps + 1)) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        np.subtract.at(net.p["ew"], w.word, 2.0 * g["ew"])
        np.subtract.at(net.p["ec"], w.gram, 2.0 * g["ec"])
    return net


def _counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds tables of the word and 5-gram buckets over labelled texts ``text``, ``y``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            tables = np.zeros((2, 2, BUCKETS), np.int64)          # label, kind, bucket
            w = Words(text_bytes(b.column(0)))
            bounds = np.append(w.first, len(w.gram))
            for y, d in zip(b.column(1).to_pylist(), w.docs):
                own = np.unique(d)
                tables[y, 0, np.unique(w.word[own])] += 1
                own = own[w.count[own] > 0]
                spans = np.repeat(w.first[own] - np.cumsum(w.count[own]) + w.count[own], w.count[own])
                tables[y, 1, np.unique(w.gram[spans + np.arange(len(spans))])] += 1
            flat = tables.reshape(2, -1)
            some = np.flatnonzero(flat.any(0))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[0, some]), pa.array(flat[1, some])],
                                             names=["k", "clean", "toxic"])

    got = (sample.select("text", "y").mapInArrow(run, "k long, clean long, toxic long")
           .groupBy("k").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    c, t = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    c[got["k"].to_numpy()], t[got["k"].to_numpy()] = got["clean"].to_numpy(), got["toxic"].to_numpy()
    n = sample.groupBy().agg(F.count(F.lit(1)), F.sum("y")).first()
    toxic, clean = float(n[1] or 0), float(n[0] - (n[1] or 0))
    share = (toxic + 1) / (toxic + clean + 2)
    odds = (np.log((t + PRIOR * share) / (toxic + PRIOR * share))
            - np.log((c + PRIOR * (1 - share)) / (clean + PRIOR * (1 - share))))
    odds[(c + t) == 0] = 0
    odds = np.clip(odds / 2, -2, 3).astype(np.float32)
    return odds[:BUCKETS], odds[BUCKETS:]


def _telling(sample: DataFrame, odds) -> DataFrame:
    """Training windows ``text``, ``y``, ``doc_id`` from labelled texts."""
    word_odds, gram_odds = odds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 300):
            texts = text_bytes(b.column(0))
            w = Words(texts)
            weight = word_odds[w.word] + w.per_word(gram_odds[w.gram], np.maximum)
            weight[0] = -4
            idx, doc = windows(w.docs)
            top = np.sort(weight[idx], 1)[:, -2:].sum(1)
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            out = []
            for y, t, d, a, e in zip(b.column(1).to_pylist(), texts, b.column(2).to_pylist(), bounds, bounds[1:]):
                best = int(top[a:e].argmax())
                picks = [best] if y else [best, zlib.crc32(t) % int(e - a)]
                words = t.split()
                out += [(b" ".join(words[p * STRIDE:p * STRIDE + WINDOW]), y, d) for p in picks]
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.int64())], names=["text", "y", "doc_id"])

    return sample.select("text", "y", "doc_id").mapInArrow(run, "text binary, y int, doc_id long")


def best_logits(docs: DataFrame, net: ToxicNet, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the highest logit over all overlapping windows of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            w = Words(text_bytes(b.column(1)))
            idx, doc = windows(w.docs)
            best = np.maximum.reduceat(net.logits(w, idx), np.searchsorted(doc, np.arange(len(w.docs))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best)], names=["doc_id", "best"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        run, "doc_id long, best double")


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> ToxicNet | None:
    """Train on labelled texts outside the held-out fold; None without labels of both kinds."""
    y = (labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("y"))
         .filter("y in (0, 1)").filter(crc_fold(F.col("_id")) != 0).groupBy("_id").agg(F.max("y").alias("y"))
         .withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(fit_rows))
    # at most fit_rows ids are broadcast, so the texts stay in place; an id may have any number of
    # rows, so the different texts are told by their hashes and again at most fit_rows are taken
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("t")).join(F.broadcast(y), F.col("doc_id") == F.col("_id"))
    chosen = cut_lineage(rows.select("_h", "doc_id", "t").distinct().orderBy("_h", "doc_id", "t").limit(fit_rows)
                         .select(F.col("doc_id").alias("c_id"), F.col("t").alias("c_t")))
    sample = cut_lineage(rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("c_id")) & (F.col("t") == F.col("c_t")))
                         .dropDuplicates(["doc_id", "t"]).drop("c_id", "c_t", "t").withColumn("part", F.pmod(F.col("_h"), F.lit(4))))
    learn, calibrate = sample.filter("part != 0"), sample.filter("part = 0")
    odds = _counts(learn)
    got = _telling(learn, odds).toArrow()
    order = np.lexsort((np.array([zlib.crc32(t) for t in got["text"].to_pylist()]), got["doc_id"].to_numpy()))
    ys = got["y"].to_numpy()[order]
    if len(ys) == 0 or ys.min() == ys.max():
        return None
    texts = got["text"].to_pylist()
    net = train([texts[i] for i in order], ys, odds)
    held = best_logits(calibrate, net, "doc_id", "text").join(
        y.select(F.col("_id"), "y"), F.col("doc_id") == F.col("_id")).select("best", "y").toArrow()
    z, t = held["best"].to_numpy(), held["y"].to_numpy().astype(float)
    if len(t) and t.min() != t.max():
        a, p = np.c_[z, np.ones(len(z))], np.array([1.0, 0.0])
        for _ in range(40):
            q = _sigmoid(np.clip(a @ p, -30, 30))
            h = (a.T * (q * (1 - q))) @ a + 1e-2 * np.eye(2)
            p = p + np.clip(np.linalg.solve(h, a.T @ (t - q) - 1e-2 * (p - [1.0, 0.0])), -1, 1)
        net.scale, net.offset = float(max(p[0], 1e-3)), float(p[1])
    return net


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Toxicity of every whole text, one row per input row.

    Returns ``doc_id``, ``held_out`` (id in the fold that is never learned from), ``score``
    (0 to 1) and ``predicted`` (1 from a score of 0.5).

    Null and empty texts score as one window without words. Null ids count as the empty text in
    the fold and are never learned from; a label row whose id repeats counts once (toxic wins).
    Without labels of both kinds every score is 0. Repeated rows are returned as given, and learned
    from once; other columns are ignored; an empty table gives no rows. ``fit_rows`` bounds the labelled texts.
    """
    net = fit(docs, labels, id_col, text_col, label_col, fit_rows)
    held = (crc_fold(F.col("doc_id")) == 0).alias("held_out")
    if net is None:
        ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
        return ids.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    best = best_logits(docs, net, id_col, text_col)
    z = F.lit(net.scale) * F.col("best") + F.lit(net.offset)
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return best.select("doc_id", held, score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
