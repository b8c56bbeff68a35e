"""Operator 1: quality classifier with hierarchical empirical Bayes over sites.

A logistic classifier over text statistics gives each document its evidence. Grouped sums of the
evidence per site path, host and corpus give Beta posteriors: the prior of a path is its host's
posterior, the prior of a host is the corpus mean, and the strength of either prior is estimated
from the spread between groups (method of moments), so sparse sites shrink towards what is above
them. The site's posterior odds, relative to the corpus, shift the document's odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import row_key, slices, text_bytes
from stockflow.session import cut_lineage

#: Labelled rows the classifier is fitted on, at most; chosen by hash of the id.
FIT_ROWS = 20_000
#: Fitted coefficients stay below this ridge; folded odds stay within +-LOGIT.
RIDGE, LOGIT = 1e-2, 12.0

_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+/:;<=>?@[\\]^_`{|}~-")] = True
N_FEATURES = 16


def features(text: bytes) -> list[float]:
    """Shares of character kinds, word variety, immediate repeats, repeated lines, lengths."""
    n = max(1, len(text))
    k = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.lower().split()
    m = max(1, len(words))
    variety = len(set(words)) / m
    space = int(k[[32, 9, 10, 11, 12, 13]].sum())
    lines = [x for x in text.split(b"\n") if x]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [np.log(n), k[65:91].sum() / n, k[48:58].sum() / n, k[_PUNCT].sum() / n, 10 * k[124] / n, k[33] / n,
            space / n, k[128:].sum() / n, variety, np.log(m) * variety, repeats / m,
            1 - len(set(lines)) / max(1, len(lines)), (n - space) / m / 10,
            list(map(len, words)).count(1) / m, (k[46] + k[44]) / m, k[10] / m]


class Logistic:
    """Ridge logistic regression over standardised features, their clipped squares and sizes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 30):
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-9
        a = self._expand(x)
        self.w = np.zeros(a.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ self.w, -30, 30)))
            h = (a.T * (p * (1 - p))) @ a + RIDGE * np.eye(len(self.w))
            self.w += np.linalg.solve(h, a.T @ (y - p) - RIDGE * self.w)

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.sd
        return np.c_[np.ones(len(z)), z, np.clip(z, -3, 3) ** 2, np.abs(z)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._expand(x) @ self.w, -LOGIT, LOGIT)


def _features_of(docs: DataFrame, id_col: str, text_col: str, host, path, key) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            x = np.array([features(t) for t in text_bytes(b.column(3))], np.float64).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], b.column(4), pa.FixedSizeListArray.from_arrays(x.ravel(), N_FEATURES).cast(pa.list_(pa.float64()))],
                names=["doc_id", "host", "path", "key", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), host.alias("host"), path.alias("path"),
                       F.col(text_col), key.alias("key")).mapInArrow(
        run, "doc_id long, host string, path string, key string, x array<double>")


def fit(rows: DataFrame, labels: DataFrame, label_col: str, fit_rows: int) -> Logistic | None:
    """Fit on at most ``fit_rows`` labelled rows, chosen by hash; None without both labels."""
    y = labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)")
    got = (rows.join(y, F.col("doc_id") == F.col("_id")).select(F.xxhash64("doc_id").alias("h"), "doc_id", "x", "y")
           .orderBy("h", "doc_id", "x", "y").limit(fit_rows).collect())
    ys = np.array([r["y"] for r in got], float)
    if len(ys) == 0 or ys.min() == ys.max():
        return None
    return Logistic(np.array([r["x"] for r in got]), ys)


def _strength(groups: DataFrame, mean: str) -> float:
    """Prior strength (pseudo-documents) from group sums ``n``, ``s`` and each group's prior mean.

    Method of moments for the Beta-binomial: the spread of group means around their prior means
    beyond sampling noise. One row of sums reaches the driver.
    """
    g = groups.filter("n > 1").select(
        F.col("n").cast("double").alias("n"), (F.col("s") / F.col("n")).alias("m"), F.col(mean).alias("p"))
    r = g.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("k"),
              F.sum(F.col("n") * (F.col("m") - F.col("p")) ** 2).alias("between"),
              F.sum(F.col("n") * F.col("p") * (1 - F.col("p"))).alias("noise")).first()
    if not r["k"] or r["k"] < 2 or not r["noise"]:
        return 20.0
    within = r["noise"] / r["n"]
    spread = (r["between"] / r["n"]) - within * r["k"] / r["n"]
    rho = min(max(spread / within, 1e-4), 0.99)
    return (1 - rho) / rho


def site_posteriors(rows: DataFrame) -> DataFrame:
    """Posterior mean of quality per (host, path) from rows ``host``, ``path``, ``p``."""
    paths = cut_lineage(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")))
    whole = paths.agg(F.sum("n"), F.sum("s")).first()
    corpus = min(max((whole[1] + 0.5) / (whole[0] + 1.0), 1e-6), 1 - 1e-6) if whole[0] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k_host = _strength(hosts.withColumn("prior", F.lit(corpus)), "prior")
    hosts = hosts.select(F.col("host").alias("_h"),
                         ((F.col("s") + k_host * corpus) / (F.col("n") + k_host)).alias("host_mean"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    k_path = _strength(paths, "host_mean")
    post = (F.col("s") + k_path * F.col("host_mean")) / (F.col("n") + k_path)
    return paths.select("host", "path", "host_mean", post.alias("path_mean"), F.lit(corpus).alias("corpus_mean"))


def _logit(p):
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", path_col: str = "lang", label_col: str = "quality",
                  site_weight: float = 0.5, threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Quality of every document, one row per input row.

    Returns ``doc_id``, ``evidence`` (the text's own log-odds), ``host_mean``, ``path_mean``
    (posterior means of its site), ``score`` (posterior probability of good quality), ``keep``
    (score at or above ``threshold``) and ``key`` (of text, host and path, on which the score depends). A site is host ``host_col`` and path ``path_col`` below it;
    null hosts and paths are sites of their own. The site moves the log-odds by ``site_weight`` x
    its own log-odds relative to the corpus.

    Null and empty texts score by their (empty) statistics. Without labels of both kinds the
    evidence is zero and everything is kept. Null ids and repeated rows are returned as given;
    repeated labels count each. Other columns are ignored; an empty table gives no rows.
    ``fit_rows`` bounds the labelled rows that the classifier is fitted on.
    """
    rows = cut_lineage(_features_of(docs, id_col, text_col, F.col(host_col).cast("string"), F.col(path_col).cast("string"),
                                     row_key(text_col, host_col, path_col)))
    model = fit(rows, labels, label_col, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            z = model.logit(x) if model is not None and len(x) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(z)], names=["doc_id", "host", "path", "key", "evidence"])

    scored = rows.mapInArrow(run, "doc_id long, host string, path string, key string, evidence double")
    sites = site_posteriors(scored.withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))))
    sites = sites.withColumnsRenamed({"host": "_h", "path": "_p"})
    out = scored.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    shift = F.lit(float(site_weight)) * (_logit(F.col("path_mean")) - _logit(F.col("corpus_mean")))
    out = out.withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + shift))))
    return out.select("doc_id", "evidence", "host_mean", "path_mean", "score",
                      (F.col("score") >= F.lit(float(threshold))).alias("keep"), "key")


def keep_good(docs: DataFrame, scores: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The documents without those that score below the threshold, with the columns of ``docs``.

    Every row is judged by the score of its own text and site, whatever its id.
    """
    bad = scores.filter(~F.col("keep")).select(F.col("key").alias("__bad")).distinct()
    keyed = docs.withColumn("__key", row_key(text_col, host_col, path_col))
    return keyed.join(bad, F.col("__key") == F.col("__bad"), "left_anti").select(*docs.columns)
