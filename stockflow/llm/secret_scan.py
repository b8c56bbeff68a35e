"""Operator 5: secret scans, rules first, then a character convolutional network.

The rules mark findings in every whole text. Every other run of key characters that is as long as
the rules' shortest value is a candidate, with its surrounding context. A small convolutional
network in numpy is trained on the labelled findings (rule findings against the other candidates),
each also with its keyword hidden so that the network learns the value too. Training starts from random
weights; each of its steps takes a share of the corpus, so that every candidate of the training folds is
learnt from, and Spark sums the gradients. The scores are calibrated on all candidates of the third fold,
which training has not seen, with the keyword before every finding hidden, and the threshold is the
highest that still recalls the wanted share of them. Candidates above it become findings of kind ``cnn``;
rule findings always stay.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import drop, slices, text_bytes
from stockflow.session import ensure_checkpoint_dir

# Kinds and patterns of the rules, in their order; bytes, so letters are ASCII.
KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")

KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")   # one is in every assign match
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
LEFT, VALUE, RIGHT = 24, 40, 8
WIDTH = LEFT + VALUE + RIGHT

_CLASS = np.zeros(256, bool)
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True

#: Steps over the corpus (each takes the texts of one hash), and how far the first half of them move a
#: weight at most; the others move it less and less.
STEPS, RATE = 24, 0.05
#: Contributions to gradients are summed in units of 1 / GRAIN, so that partitions do not matter.
GRAIN = 2.0 ** 24
#: Logits are counted in bins of 1 / BINS between -SPAN and SPAN.
BINS, SPAN = 256, 64
RESULT = ("doc_id long, n_assign long, n_access long, n_hex long, n_cnn long, base_sha256 string, spans string")


@dataclass
class Candidates:
    """Runs of MIN_VALUE or more key characters in the texts of one buffer, by text and start."""

    buffer: np.ndarray     # the texts, with LEFT newlines before, between and behind
    first: np.ndarray      # place of each text in the buffer
    doc: np.ndarray
    start: np.ndarray      # in the buffer
    end: np.ndarray
    label: np.ndarray      # 1 overlaps the value of a rule finding, 2 only its keyword, 0 neither
    value: np.ndarray      # start of the part that the network is trained on: the value, without its keyword

    def windows(self, k: np.ndarray) -> np.ndarray:
        """First windows of the candidates ``k``."""
        p, end = self.value[k], self.end[k]
        view = np.lib.stride_tricks.sliding_window_view
        x = np.empty((len(k), WIDTH), np.uint8)
        x[:, :LEFT] = view(self.buffer, LEFT)[p - LEFT]
        x[:, LEFT:LEFT + VALUE] = view(np.append(self.buffer, np.zeros(VALUE, np.uint8)), VALUE)[p]
        x[:, LEFT:LEFT + VALUE][np.arange(VALUE) >= (end - p)[:, None]] = 0
        x[:, LEFT + VALUE:] = view(self.buffer, RIGHT)[end]
        return x


def rule_spans(text: bytes, runs: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Byte spans (start, end, kind) of the rules, and those (start, end) of their values."""
    out, values = [], []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                out.append((m.start(), m.end(), 0))
                values.append(m.span(2))
    if b"AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    for s, e in runs:
        out += [(s + m.start(), s + m.end(), 2) for m in HEX.finditer(text[s:e])]
    values += [(s, e) for s, e, k in out if k]
    return sorted(out, key=lambda x: (x[0], x[2])), values


def _overlap(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each of the runs overlaps one of the spans."""
    if not spans:
        return np.zeros(len(start), bool)
    a, b = np.array(sorted(spans)).T
    n = np.searchsorted(a, end, side="left")               # spans that begin before the run's end
    return (n > 0) & (np.maximum.accumulate(b)[np.maximum(n - 1, 0)] > start)


def survey(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], Candidates]:
    """Rule spans of each text, in bytes, and the candidates of all."""
    gap = b"\n" * LEFT
    a = np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + LEFT
    first = np.cumsum(lens) - lens + LEFT
    inside = _CLASS[a]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    long = end - start >= MIN_VALUE
    start, end = start[long], end[long]
    doc = np.searchsorted(first, start, side="right") - 1
    label, value = np.zeros(len(start), np.int8), start.copy()
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    hexes: dict[int, list[tuple[int, int]]] = {}
    for k in np.flatnonzero(end - start >= MIN_HEX).tolist():
        d = int(doc[k])
        hexes.setdefault(d, []).append((int(start[k] - first[d]), int(end[k] - first[d])))
    spans = []
    for d, text in enumerate(texts):
        base, values = rule_spans(text, hexes.get(d, []))
        spans.append(base)
        if base:
            at = slice(cut[d], cut[d + 1])
            s, e = start[at] - first[d], end[at] - first[d]
            label[at] = np.where(_overlap(s, e, values), 1, 2 * _overlap(s, e, [(x, y) for x, y, _ in base]))
            for x, y in values:                            # a keyword inside the run is not its value
                k = int(cut[d] + np.searchsorted(s, x, side="right") - 1)
                if k >= cut[d] and start[k] == value[k] and x < end[k] - first[d] and _keyword(text[start[k] - first[d]:x]):
                    value[k] = x + first[d]
    return spans, Candidates(a, first, doc, start, end, label, value)


def _keyword(before: bytes) -> bool:
    low = before.lower()
    return any(k in low for k in KEYWORDS)


def in_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points."""
    if not spans or text.isascii():
        return spans
    at = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    return [(int(at[s]), int(at[e]), k) for s, e, k in spans]


def windows(text: bytes, start: int, end: int) -> list[bytes]:
    """The candidate with its context, in as many windows as its length needs."""
    return [text[max(0, p - LEFT):p].rjust(LEFT, b"\n") + text[p:min(end, p + VALUE)].ljust(VALUE, b"\0")
            + text[end:end + RIGHT].ljust(RIGHT, b"\n") for p in range(start, end, VALUE)]


@dataclass
class CharCNN:
    """Symbol embeddings, one convolution, maximum pooling, one hidden layer, a calibrated score."""

    embed: np.ndarray      # 256 x E
    conv: np.ndarray       # K*E x C
    bias: np.ndarray
    head: np.ndarray       # 2C x 1, over the maxima left of the value and in and after it
    shift: float
    scale: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    KERNEL = 5

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.embed[x]                                             # n x W x E
        w = np.lib.stride_tricks.sliding_window_view(e, self.KERNEL, axis=1)   # n x P x E x K
        return w.transpose(0, 1, 3, 2).reshape(len(x), w.shape[1], -1)

    def _maps(self, x: np.ndarray):
        patches = self._patches(x)
        act = patches @ self.conv + self.bias                          # n x P x C
        cut = LEFT - self.KERNEL + 1
        pools = [(0, cut), (cut, act.shape[1])]
        top = [a + act[:, a:b].argmax(1) for a, b in pools]
        n, c = np.arange(len(x))[:, None], np.arange(act.shape[2])[None]
        pooled = np.concatenate([np.maximum(act[n, t, c], 0) for t in top], 1)
        return patches, act, top, pooled

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._maps(x)[3] @ self.head[:, 0] + self.shift

    def tops(self, x: np.ndarray) -> np.ndarray:
        """Highest maps left of the value and from it on; the place of each is in its lowest 7 bits."""
        p01, p23, p4 = self._tables
        x = np.ascontiguousarray(x.T).astype(np.int64)
        two = x[:-1] << 8 | x[1:]
        act = p01.take(two[:-3], 0)                        # by place, window and channel
        act += p23.take(two[2:-1], 0)
        act += p4.take(x[4:], 0)
        bits = act.view(np.int32)
        bits &= ~127
        bits |= np.arange(len(act), dtype=np.int32)[:, None, None]
        cut = LEFT - self.KERNEL + 1
        return np.concatenate([act[:cut].max(0), act[cut:].max(0)], 1)

    def pooled_logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tops, what the head sees of them, and logits, whatever other windows are in ``x``."""
        top = self.tops(x)
        pooled = np.maximum(top + np.tile(self.bias, 2), 0)
        return top, pooled, (pooled * self.head[:, 0]).sum(1) + self.shift

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.logit(x[i:i + 512]) for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)
        return self.calibrated(z)

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * z + self.offset)))

    def run_scores(self, c: Candidates, k: np.ndarray) -> np.ndarray:
        """Scores of the candidates ``k``, from their starts; the highest of a long one's windows.

        Maps of the text itself are made once for all windows that hold them. A window adds the
        places where its value meets the filling and the filling meets the text behind; more
        than KERNEL filling bytes change no maximum.
        """
        out = np.empty(len(k))
        short = c.end[k] - c.start[k] <= VALUE - self.KERNEL
        for i in np.flatnonzero(~short).tolist():
            s, e = int(c.start[k[i]]), int(c.end[k[i]])
            x = encode(windows(c.buffer[s - LEFT:e + RIGHT].tobytes(), LEFT, LEFT + e - s))
            out[i] = self.score(x).max()
        rest = np.flatnonzero(short)
        for at in self._stretches(c, k, rest):
            s, e = c.start[k[at]], c.end[k[at]]
            lo = int(s[0]) - LEFT
            out[at] = self.calibrated(self._short_logits(c.buffer[lo:int(e[-1]) + RIGHT], s - lo, e - lo))
        return out

    def may_pass(self, c: Candidates, k: np.ndarray) -> np.ndarray:
        """Whether the candidates ``k`` may reach the threshold; never no for one whose score does.

        Maps in 8 bits bound the logits of the short ones from above.
        """
        if not (0 < self.threshold <= 1 and self.scale > 0):
            return np.full(len(k), self.threshold <= 1)
        odds = 30.0 if self.threshold == 1 else min(30.0, np.log(self.threshold) - np.log1p(-self.threshold))
        least = (odds - self.offset) / self.scale - 0.01   # a logit below it is below the threshold
        out = c.end[k] - c.start[k] > VALUE - self.KERNEL
        rest = np.flatnonzero(~out)
        unit, low, *tables = self._byte_tables
        n = len(unit)
        head, off = self.head[:, 0], np.tile(low + self.bias, 2)
        off = (off + np.sign(head) * np.tile(1.5 * unit + 1e-4 * (1 + np.abs(low) + 255 * unit), 2)).astype(np.float32)
        unit, head = np.tile(unit, 2).astype(np.float32), head.astype(np.float32)
        for at in self._stretches(c, k, rest):
            s, e = c.start[k[at]], c.end[k[at]]
            lo = int(s[0]) - LEFT
            tops = self._short_tops(c.buffer[lo:int(e[-1]) + RIGHT], s - lo, e - lo, tables)
            tops = np.concatenate([t[:, :n] for t in tops], 1)
            out[at] = np.maximum(tops * unit + off, 0) @ head + self.shift >= least
        return out

    @staticmethod
    def _stretches(c: Candidates, k: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The candidates ``k[at]`` by bounded stretches of text, without long gaps."""
        if not len(at):
            return []
        s = c.start[k[at]]
        return np.split(at, np.flatnonzero((np.diff(s >> 14) != 0) | (np.diff(s) > 512)) + 1)

    @cached_property
    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the first two, the next two and the last symbol under the kernel add to a map."""
        taps = (self.embed @ self.conv.reshape(self.KERNEL, -1, self.conv.shape[1])).astype(np.float32)
        return *((taps[k][:, None] + taps[k + 1]).reshape(-1, taps.shape[2]) for k in (0, 2)), taps[4]

    @cached_property
    def _byte_tables(self) -> tuple[np.ndarray, ...]:
        """The tables in whole units from the lowest value on, so that a sum of three fits 8 bits: the unit
        and the lowest sum of each channel, then the tables. A sum is off by 1.5 units at most."""
        low = [t.min(0).astype(float) for t in self._tables]
        unit = sum(t.max(0) - x for t, x in zip(self._tables, low)) / 252 + 1e-9
        wide = -len(unit) % 32                             # rows of 32 bytes are taken fastest
        return unit, sum(low), *(np.pad(np.rint((t - x) / unit).astype(np.uint8), ((0, 0), (0, wide)))
                                 for t, x in zip(self._tables, low))

    def _short_logits(self, a: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        top = np.concatenate(self._short_tops(a, s, e, self._tables), 1)
        return np.maximum(top + np.tile(self.bias, 2), 0) @ self.head[:, 0] + self.shift

    def _short_tops(self, a: np.ndarray, s: np.ndarray, e: np.ndarray,
                    tables: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Highest maps left of the values and from them on."""
        n, (p01, p23, p4) = self.KERNEL, tables

        def maps(x: np.ndarray) -> np.ndarray:
            two = x[..., :-1].astype(np.int64) << 8 | x[..., 1:]
            out = p01.take(two[..., :-3], 0)
            out += p23.take(two[..., 2:-1], 0)
            out += p4.take(x[..., 4:], 0)
            return out

        m = {1: maps(a)}                                   # highest of 1, 2, 4, .. maps from each place
        for w in (1, 2, 4, 8):
            m[2 * w] = np.maximum(m[w][:-w], m[w][w:])
        left = np.maximum(m[16].take(s - LEFT, 0), m[16].take(s - n + 1 - 16, 0))
        seam = np.zeros((len(s), 3 * n - 2), np.uint8)
        seam[:, :n - 1] = a[e[:, None] + np.arange(1 - n, 0)]
        seam[:, 2 * n - 1:] = a[e[:, None] + np.arange(n - 1)]
        right = np.maximum(maps(seam).max(1), m[RIGHT - n + 1].take(e, 0))
        size = e - s
        for w in (4, 8, 16):
            i = np.flatnonzero((size >= w) & (size < 2 * w if w < 16 else size >= w))
            p, q = s[i] - n + 1, e[i] - n + 1              # maps inside the value and its last left bytes
            top = np.maximum(m[w].take(p, 0), m[w].take(q - w, 0))
            if w == 16:
                top = np.maximum(top, m[w].take(np.minimum(p + w, q - w), 0))
            right[i] = np.maximum(right[i], top)
        return left, right


def encode(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WIDTH)


class Adam:
    """Adam over the weights of a network, in place."""

    def __init__(self, rate: float):
        self.rate, self.steps = rate, 0
        self.m, self.v = {}, {}

    def step(self, net: CharCNN, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for k in ("embed", "conv", "bias", "head", "shift"):
            m = self.m[k] = 0.9 * self.m.get(k, 0.0) + 0.1 * g[k]
            v = self.v[k] = 0.999 * self.v.get(k, 0.0) + 0.001 * g[k] ** 2
            setattr(net, k, getattr(net, k) - self.rate * (m / (1 - 0.9 ** self.steps))
                    / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-8))


def platt(z: np.ndarray, t: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Scale and offset that calibrate the logits ``z`` of labels ``t``, each seen ``n`` times."""
    w = np.zeros(2)
    a = np.c_[z, np.ones(len(z))]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a.T * (n * p * (1 - p))) @ a + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (n * (t - p)) - 1e-3 * w)
    return float(w[0]), float(w[1])


def untrained(rng: np.random.Generator, channels: int = 24, dim: int = 8) -> CharCNN:
    """A network of random weights."""
    return CharCNN(rng.normal(0, 0.3, (256, dim)), rng.normal(0, (dim * 5) ** -0.5, (dim * 5, channels)),
                   np.zeros(channels), rng.normal(0, 0.1, (2 * channels, 1)), 0.0)


def train_cnn(x: np.ndarray, y: np.ndarray, recall: float = 0.98, epochs: int = 6, channels: int = 24,
              dim: int = 8, seed: int = 7, held: np.ndarray | None = None) -> CharCNN | None:
    """Fit on windows ``x`` with labels ``y`` in small batches; the rows ``held`` (every third) calibrate.

    None without both labels. For windows at hand; ``fit`` learns from a corpus.
    """
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 3 == 2 if held is None else held
    if min((y[~held] == 1).sum(), (y[~held] == 0).sum(), (y[held] == 1).sum(), (y[held] == 0).sum()) < 3:
        return None
    net = untrained(rng, channels, dim)
    adam = Adam(0.01)
    tx, ty = x[~held], y[~held]
    pos, neg = np.flatnonzero(ty == 1), np.flatnonzero(ty == 0)
    for _ in range(epochs):
        for _ in range(max(8, min(60, len(ty) // 64))):
            pick = np.concatenate([rng.choice(pos, 32), rng.choice(neg, 32)])
            b = tx[pick].copy()
            hide = rng.random(32) < 0.5        # half of the findings with another candidate's context
            b[:32][hide, :LEFT] = tx[rng.choice(neg, int(hide.sum()))][:, :LEFT]
            t = ty[pick].astype(float)
            patches, act, top, pooled = net._maps(b)
            p = 1 / (1 + np.exp(-(pooled @ net.head[:, 0] + net.shift)))
            dz = (p - t) / len(t)
            g = {"head": pooled.T @ dz[:, None], "shift": dz.sum()}
            dpool = dz[:, None] * net.head[:, 0][None] * (pooled > 0)
            dact = np.zeros_like(act)
            n, c = np.arange(len(b))[:, None], np.arange(channels)[None]
            for i, at in enumerate(top):
                np.add.at(dact, (n, at, c), dpool[:, i * channels:(i + 1) * channels])
            g["conv"] = np.tensordot(patches, dact, ((0, 1), (0, 1)))
            g["bias"] = dact.sum((0, 1))
            dpatch = (dact @ net.conv.T).reshape(len(b), act.shape[1], 5, dim)
            de = np.zeros_like(net.embed)
            for k in range(5):
                np.add.at(de, b[:, k:k + act.shape[1]], dpatch[:, :, k])
            g["embed"] = de
            adam.step(net, g)
    # Platt scaling on the held rows, then the highest threshold that keeps the recall. The rows that
    # it gates have no keyword of the rules, so every held finding is judged in another's context.
    hx, t = x[held].copy(), y[held].astype(float)
    hx[t == 1, :LEFT] = hx[rng.choice(np.flatnonzero(t == 0), int(t.sum()))][:, :LEFT]
    z = np.concatenate([net.logit(hx[i:i + 512]) for i in range(0, len(hx), 512)])
    net.scale, net.offset = platt(z, t, np.ones(len(z)))
    ps = np.sort(net.score(hx[t == 1]))
    net.threshold = float(ps[int(np.floor((1 - recall) * len(ps)))])
    return net


def _hashes(x: np.ndarray) -> np.ndarray:
    """A hash of each window."""
    h = np.zeros(len(x), np.uint64)
    with np.errstate(over="ignore"):
        for part in np.ascontiguousarray(x).view(np.uint64).T:
            h = (h ^ part) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return (h * np.uint64(0x94D049BB133111EB)).view(np.int64)


def _is_held(h: np.ndarray) -> np.ndarray:
    """Whether windows of these hashes are of the fold that calibrates: all copies of one are."""
    return h.view(np.uint64) % np.uint64(3) == 2


def _hidden(c: Candidates, spans: list, others: np.ndarray, k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Windows of the findings ``k`` with another context in place of their own: that of one of the
    candidates ``others`` of the same text, chosen by the finding's hash, which no rule finding reaches
    into; without any, that of the text's start."""
    out, at = c.windows(k), c.first[c.doc[k]]
    cut = np.searchsorted(c.doc[others], np.arange(len(spans) + 1))
    free: dict[int, np.ndarray] = {}
    for i, d in enumerate(c.doc[k].tolist()):
        if d not in free:
            s = c.start[others[cut[d]:cut[d + 1]]]
            inner = s - c.first[d]
            free[d] = s[~_overlap(inner - LEFT, inner, [(x, y) for x, y, _ in spans[d]])]
        if len(free[d]):
            at[i] = free[d][(int(h[i]) % 2 ** 64 >> 8) % len(free[d])]
    out[:, :LEFT] = np.lib.stride_tricks.sliding_window_view(c.buffer, LEFT)[at - LEFT]
    return out


def folds(texts: list[bytes], rows: int, held: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """All candidates of the fold that calibrates or of the others, at most ``rows`` at a time: their
    label, first windows, and for findings those with another context."""
    spans, c = survey(texts)
    others = [np.zeros(0, int)]
    for y in (0, 1):
        all_y = np.flatnonzero(c.label == y)
        before = np.concatenate(others) if y and len(all_y) else None
        for i in range(0, len(all_y), rows):
            k = all_y[i:i + rows]
            x = c.windows(k)
            h = _hashes(x)
            own = _is_held(h) == held
            if y:
                yield y, x[own], _hidden(c, spans, before, k[own], h[own])
            else:
                others.append(k[own])
                yield y, x[own], None


def packed(x: np.ndarray, rows: int = 256) -> Iterator[np.ndarray]:
    """The windows in parts, by the length of their values; filling that changes no maximum is left out."""
    size, low = (x[:, LEFT:LEFT + VALUE] != 0).sum(1), -1
    for high in (8, 12, 16, 24, VALUE):
        part = x[(size > low) & (size <= high)]
        part = np.concatenate([part[:, :LEFT + min(high + CharCNN.KERNEL, VALUE)], part[:, LEFT + VALUE:]], 1)
        low = high
        for i in range(0, len(part), rows):
            yield part[i:i + rows]


def gradient(net: CharCNN, x: np.ndarray, y: int) -> np.ndarray:
    """Sum over the windows ``x`` of label ``y`` of the loss's gradient, in units of 1 / GRAIN: by tap,
    symbol and channel, then by channel, by head, of the shift, and the number of windows."""
    channels = len(net.bias)
    taps = np.zeros((net.KERNEL, 256 * channels))
    rest = np.zeros(3 * channels + 2)
    own = np.tile(np.arange(channels), 2)
    scaled = net.head[:, 0] * GRAIN
    for b in packed(x):
        top, pooled, z = net.pooled_logits(b)
        dz = 1 / (1 + np.exp(-z)) - y
        g = dz[:, None] * scaled
        np.rint(g, out=g)
        g *= pooled > 0
        at = np.flatnonzero(g)
        w, c, flat = g.ravel().take(at), own.take(at % len(own)), b.astype(np.int64).ravel() * channels
        place = (top.view(np.int32) & 127) + np.arange(0, b.size, b.shape[1])[:, None]
        place = place.ravel().take(at)
        for k in range(net.KERNEL):
            taps[k] += np.bincount(flat.take(place + k) + c, w, taps.shape[1])
        both = g.sum(0)
        rest += np.concatenate([both[:channels] + both[channels:], np.rint(pooled * (dz * GRAIN)[:, None]).sum(0),
                                [np.rint(dz * GRAIN).sum(), len(b)]])
    return np.concatenate([taps.ravel(), rest]).astype(np.int64)


def _by_weight(net: CharCNN, sums: np.ndarray) -> dict[str, np.ndarray]:
    """The sums of ``gradient`` (a row a label) as the gradient of the weights; labels count alike."""
    channels, dim = len(net.bias), net.embed.shape[1]
    mean = sum(row[:-1] / GRAIN / row[-1] for row in sums if row[-1]) / 2
    taps, rest = np.split(mean, [net.KERNEL * 256 * channels])
    taps = taps.reshape(net.KERNEL, 256, channels)
    conv = net.conv.reshape(net.KERNEL, dim, channels)
    return {"embed": sum(t @ w.T for t, w in zip(taps, conv)),
            "conv": np.concatenate([net.embed.T @ t for t in taps]),
            "bias": rest[:channels], "head": rest[channels:3 * channels, None], "shift": rest[-1]}


def _corpus_step(net: CharCNN, texts: DataFrame, rows: int) -> np.ndarray:
    """Sums of ``gradient``, a row a label, over all candidates of the training folds in the texts; each
    finding as it stands and with its keyword hidden."""
    size = net.KERNEL * 256 * len(net.bias) + 3 * len(net.bias) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, size), np.int64)
        for b in slices(batches, 300):
            for y, x, hidden in folds(text_bytes(b.column(0)), rows, held=False):
                out[y] += gradient(net, np.concatenate([x, hidden]) if y else x, y)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.reshape(-1)[at])], names=["i", "v"])

    out = np.zeros(2 * size, np.int64)
    for i, v in texts.mapInArrow(run, "i long, v long").groupBy("i").agg(F.sum("v")).collect():
        out[i] = v
    return out.reshape(2, size)


def _calibrate(net: CharCNN, texts: DataFrame, rows: int, recall: float) -> bool:
    """Platt scaling on all candidates of the third fold, then the highest threshold that keeps the recall;
    whether that fold has three or more of each label.

    The rows that the threshold gates have no keyword of the rules, so every finding is judged in
    another's context. What reaches the driver is a count for each label and bin of logits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, 2 * SPAN * BINS + 1), np.int64)
        for b in slices(batches, 300):
            for y, x, hidden in folds(text_bytes(b.column(0)), rows, held=True):
                for part in packed(hidden if y else x):
                    z = np.clip(net.pooled_logits(part)[2], -SPAN, SPAN)
                    out[y] += np.bincount(np.rint((z + SPAN) * BINS).astype(np.int64), minlength=out.shape[1])
        y, at = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(at), pa.array(out[y, at])], names=["y", "bin", "n"])

    rows_ = texts.mapInArrow(run, "y long, bin long, n long").groupBy("y", "bin").agg(F.sum("n")).collect()
    t, at, n = np.array(sorted(map(tuple, rows_)), np.int64).reshape(-1, 3).T
    if min(n[t == 1].sum(), n[t == 0].sum()) < 3:
        return False
    z = at / BINS - SPAN
    net.scale, net.offset = platt(z, t, n)
    edge = np.minimum(*(net.calibrated(z[t == 1] + d / BINS) for d in (-0.5, 0.5)))    # the bin's lower one
    order = np.argsort(edge, kind="stable")
    upto = np.cumsum(n[t == 1][order])
    lost = max(0, int(np.floor((1 - recall) * (upto[-1] + 1))) - 1)    # of held findings, so that unseen ones keep it
    net.threshold = float(edge[order][np.searchsorted(upto, lost, side="right")])
    return True


def fit(docs: DataFrame, text_col: str, rows: int = 6000, recall: float = 0.98, seed: int = 7) -> CharCNN | None:
    """Train on all candidates of the corpus.

    From random weights, each of ``STEPS`` takes all candidates in one share of the texts, so every
    text is learnt from once; calibration and threshold come from all held-out candidates. None with
    fewer than three of a label in the folds that train or in the one that calibrates. ``rows`` bounds
    the windows that a task holds at once and changes nothing else. The texts lie by share in the
    shared folder while training lasts, so that a step reads its own only.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/secrets-{uuid.uuid4().hex}"
    try:
        (texts.filter(F.length("text") >= MIN_VALUE).withColumn("share", F.pmod(F.xxhash64("text"), F.lit(STEPS)).cast("int"))
         .write.partitionBy("share").parquet(at))
        shares = spark.read.schema("text string, share int").parquet(at)
        net = _learn(shares, rows, seed)
        return net if net is not None and _calibrate(net, texts, rows, recall) else None
    finally:
        drop(spark, at)


def _learn(shares: DataFrame, rows: int, seed: int) -> CharCNN | None:
    """The network after a step over each share."""
    net = untrained(np.random.default_rng(seed))
    adam, seen, sums = Adam(RATE), 0, 0
    for s in range(STEPS):
        sums = sums + _corpus_step(net, shares.filter(F.col("share") == s).select("text"), rows)
        if sums[:, -1].all() or s == STEPS - 1 and sums[:, -1].any():      # a share of one label waits for the next
            adam.rate = RATE * min(1, 2 - 2 * s / STEPS)
            adam.step(net, _by_weight(net, sums))
            seen, sums = seen + sums[:, -1], 0
    return net if np.min(seen) >= 3 else None


def scan(texts: list[bytes], net: CharCNN | None = None) -> Iterator[tuple[list, list]]:
    """Spans of the rules, and of the other candidates that the network accepts, in code points."""
    spans, c = survey(texts)
    k = np.flatnonzero(c.label == 0) if net is not None else np.zeros(0, int)
    if len(k):
        k = k[net.may_pass(c, k)]
        k = k[net.run_scores(c, k) >= net.threshold]
    cut = np.searchsorted(c.doc[k], np.arange(len(texts) + 1))
    for d, (text, base) in enumerate(zip(texts, spans)):
        at = k[cut[d]:cut[d + 1]]
        more = [(s, e, 3) for s, e in zip((c.start[at] - c.first[d]).tolist(), (c.end[at] - c.first[d]).tolist())]
        both = in_points(text, base + more)
        yield both[:len(base)], both[len(base):]


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 6000,
                 recall: float = 0.98) -> DataFrame:
    """Findings in every whole text, one row per input row.

    Returns ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_cnn``, ``base_sha256`` (of the
    rules' spans) and ``spans`` (``kind:start:end`` in code points, end exclusive, by start then
    kind, comma-joined).

    Null and empty texts have no findings (the hash is that of the empty text). Null ids and
    repeated rows are returned as given. With fewer than a few labelled findings of either label
    no network is trained and only the rules speak. Other columns are ignored; an empty table
    gives no rows. ``rows`` bounds the windows that a task holds at once in training.
    """
    net = fit(docs, text_col, rows, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 300):
            out = []
            for base, more in scan(text_bytes(b.column(1)), net):
                n = [sum(k == i for _, _, k in base) for i in range(3)]
                out.append((*n, len(more), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_cnn", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, RESULT)


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping spans become one mark."""
    cut = sorted(tuple(map(int, x.split(":")[1:])) for x in spans.split(",") if x)
    out, at, last = [], 0, -1
    for s, e in cut:
        if s >= last:
            out += [text[at:s], mark]
        at = last = max(last, e)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     chars_col: str = "n_chars", rows: int = 6000, recall: float = 0.98) -> DataFrame:
    """The documents with every finding replaced, with the columns of ``docs``.

    The texts are scanned where they lie, so rows with equal or null ids do not mix.
    """
    net = fit(docs, text_col, rows, recall)
    cols, types = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cols.index(text_col)
        chars = cols.index(chars_col) if chars_col in cols else -1
        for b in slices(batches, 300):
            own = b.column(at).to_pylist()
            lens = b.column(chars).to_pylist() if chars >= 0 else []
            for i, (base, more) in enumerate(scan(text_bytes(b.column(at)), net)):
                spans = joined(base + more)
                if spans:
                    own[i] = redact(own[i], spans)
                    if chars >= 0:
                        lens[i] = len(own[i])
            arrays = list(b.columns)
            arrays[at] = pa.array(own, b.column(at).type)
            if chars >= 0:
                arrays[chars] = pa.array(lens, b.column(chars).type)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return docs.mapInArrow(run, types)
