"""The corpus pipeline against a brute-force chain, stage by stage, and its reruns."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from stockflow.llm import secret_scan
from stockflow.llm.common import row_key
from stockflow.llm.packing import piece_lengths
from stockflow.llm.quality import LOGIT, Logistic, features
from stockflow.llm.queries import VOCABULARY
from tests.llm.test_mixing import sql_rows
from tests.llm.test_simhash import brute_fp, brute_groups

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, taken long, row string, key string, fp long"


def corpus():
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(260):
        good = i % 5 != 0
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(30, 90))]
        text = " ".join(words) if good else rnd.choice([" ".join([words[0]] * 60), "!! ".join(words).upper()])
        if i % 9 == 1:
            text += f"\npassword = {''.join(rnd.choice('ABCDEFabcdef0123456789') for _ in range(14))}\n"
        rows.append([i, text, rnd.choice(["en", "de", None]), rnd.choice(["big", "big", "big", "s1", "s2", None])])
        if i % 2:
            labels.append((i, int(good), 0))
    hot = rows[1][1]
    rows += [[1000 + i, hot, "en", "big"] for i in range(60)]                          # exact copies
    rows += [[2000 + i, hot + f" tail{i}", "en", "s1"] for i in range(6)]              # near copies
    rows += [[None, rows[3][1] + " alpha beta gamma delta", "en", "s2"], [None, rows[5][1][::-1], "en", "s2"]]
    rows += [[7, rows[8][1] + " other words follow here", "de", "s1"], [7, rows[10][1][::-1], "de", "s1"]]
    rows += [[3000, None, None, None], [3001, "", "en", "s1"], [None, None, "en", "big"], [None, "", "en", "big"],
             [3002, " ".join(rnd.choice(vocab) for _ in range(30_000)), "en", "only"]]
    rows += [list(rows[12]) for _ in range(40)]                                        # rows alike in every column
    return [(i, t, la, s, None if t is None else len(t), 5, 6, "r", "k", 9) for i, t, la, s in rows], labels


@pytest.fixture(scope="module")
def folder(llm_spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    llm_spark.createDataFrame(rows, COLUMNS).repartition(5).write.parquet(f"{at}/documents.parquet")
    llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def tuples(df):
    return [tuple(r) for r in df.collect()]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return np.log(p / (1 - p))


def spread(groups):
    """Prior strength from (n, sum, prior mean) of groups, by the method of moments."""
    g = [(n, s / n, p) for n, s, p in groups if n > 1]
    noise = sum(n * p * (1 - p) for n, _, p in g)
    if len(g) < 2 or not noise:
        return 20.0
    total = sum(n for n, _, _ in g)
    within = noise / total
    rho = (sum(n * (m - p) ** 2 for n, m, p in g) / total - within * len(g) / total) / within
    rho = min(max(rho, 1e-4), 0.99)
    return (1 - rho) / rho


def brute_quality(rows, labels):
    """Score of each row: evidence, path and host posteriors in plain sums."""
    x = np.array([features((r[1] or "").encode()) for r in rows])
    y = {i: q for i, q, _ in labels}
    learn = [k for k, r in enumerate(rows) if r[0] in y]
    z = Logistic(x[learn], np.array([float(y[rows[k][0]]) for k in learn])).logit(x)
    assert abs(z).max() <= LOGIT
    p = 1 / (1 + np.exp(-z))
    paths, hosts = {}, {}
    for r, q in zip(rows, p):
        for d, k in ((paths, (r[3], r[2])), (hosts, r[3])):
            n, s = d.get(k, (0, 0.0))
            d[k] = (n + 1, s + q)
    corpus_mean = (p.sum() + 0.5) / (len(p) + 1)
    k_host = spread([(n, s, corpus_mean) for n, s in hosts.values()])
    host = {h: (s + k_host * corpus_mean) / (n + k_host) for h, (n, s) in hosts.items()}
    k_path = spread([(n, s, host[k[0]]) for k, (n, s) in paths.items()])
    path = {k: (s + k_path * host[k[0]]) / (n + k_path) for k, (n, s) in paths.items()}
    shift = np.array([0.5 * (logit(path[r[3], r[2]]) - logit(corpus_mean)) for r in rows])
    return 1 / (1 + np.exp(-(z + shift)))


def test_quality_stage(llm_spark, folder):
    docs = cp.read(llm_spark, folder, "documents")
    rows, labels = tuples(docs), corpus()[1]
    score = brute_quality(rows, labels)
    assert abs(score - 0.5).min() > 1e-6
    out = cp.quality_stage(llm_spark, docs, folder)
    assert out.columns == docs.columns
    same(tuples(out), [r for r, s in zip(rows, score) if s >= 0.5])
    assert 20 < (score < 0.5).sum() < 80
    from stockflow.llm.quality import score_quality
    got = score_quality(docs, cp.read(llm_spark, folder, "labels")).select("doc_id", "score").collect()
    for a, b in zip(sorted((repr(r.doc_id), r.score) for r in got), sorted((repr(r[0]), s) for r, s in zip(rows, score))):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-6


def keys_of(docs):
    cols = [c for c in docs.columns if c != "text"]
    return [tuple(r) for r in docs.select(*docs.columns, row_key("text", *cols).alias("__k")).collect()]


def test_near_dedup_stage(llm_spark, folder):
    docs = cp.read(llm_spark, folder, "documents")
    keyed = keys_of(docs)
    fps = sorted({brute_fp(r[1]) for r in keyed})
    lab = dict(zip(fps, brute_groups(fps, 4)))
    best = {}
    for r in keyed:
        order = (r[0] is None, r[0] or 0, r[-1])
        g = lab[brute_fp(r[1])]
        if g not in best or order < best[g][0]:
            best[g] = (order, r[:-1])
    out = cp.near_dedup_stage(llm_spark, docs, folder)
    assert out.columns == docs.columns
    same(tuples(out), [r for _, r in best.values()])


def test_secrets_stage(llm_spark, folder):
    docs = cp.read(llm_spark, folder, "documents")
    net = secret_scan.fit(docs, "text", 6000, 0.98)
    want = []
    for r in tuples(docs):
        base, more = next(iter(secret_scan.scan([(r[1] or "").encode()], net)))
        spans = secret_scan.joined(base + more)
        text = secret_scan.redact(r[1], spans) if spans else r[1]
        want.append((r[0], text, *r[2:4], len(text) if spans else r[4], *r[5:]))
    out = cp.secrets_stage(llm_spark, docs, folder)
    assert out.columns == docs.columns
    same(tuples(out), want)
    assert sum("[SECRET]" in (r[1] or "") for r in want) >= 25


def word_runs(text, n):
    """The text up to the end of its n-th word."""
    out, at, seen = text.encode(), 0, 0
    blank = b" \t\n\x0b\x0c\r"
    while seen < n:
        while out[at:at + 1] in {bytes([c]) for c in blank}:
            at += 1
        while at < len(out) and out[at] not in blank:
            at += 1
        seen += 1
    return out[:at].decode()


def brute_mix(keyed):
    """Rows as the mix takes them: budgets from the SQL text, places by sorting in Python."""
    budget = {}
    for i, size, source_size, target, taken in sql_rows([(r[0], r[1], r[3]) for r in keyed]):
        budget.setdefault((source_size, target), 0)
    by = {}
    for r in keyed:
        size = len((r[1] or "").encode().split())
        key = "mix|" + (str(r[0]) if r[0] is not None else "|" + hashlib.md5((r[1] or "").encode()).hexdigest())
        by.setdefault(r[3], []).append((hashlib.md5(key.encode()).hexdigest(), size, r[-1], r[:-1]))
    out = []
    for members in by.values():
        total = sum(m[1] for m in members)
        target = next(t for s, t in budget if s == total)
        whole, rest = divmod(int(target), total) if total else (0, 0)
        for _, size, _, r in sorted(members, key=lambda m: m[:3]):
            part = max(0, min(size, rest))
            rest -= size
            out += [r] * (whole if size else 0)
            if part == size and size:
                out.append(r)
            elif part:
                text = word_runs(r[1], part)
                out.append((r[0], text, *r[2:4], len(text), *r[5:]))
    return out


def test_mixing_stage(llm_spark, folder):
    docs = cp.read(llm_spark, folder, "documents")
    want = brute_mix(keys_of(docs))
    out = cp.mixing_stage(llm_spark, docs, folder)
    assert out.columns == docs.columns
    same(tuples(out), want)


def test_packing_stage(llm_spark, folder):
    docs = cp.read(llm_spark, folder, "documents")
    tok = Tokenizer.from_str(open(VOCABULARY.json).read())
    want = []
    for r in tuples(docs):
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(piece_lengths(len(ids), 2048)):
            want.append((r[0], k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
    check_packing(cp.packing_stage(llm_spark, docs, folder).collect(), want)


def check_packing(rows, want):
    same([tuple(r)[:5] for r in rows], want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * sum(w[3] for w in want) / 2048 + 2


def test_whole_run_and_rerun(llm_spark, folder):
    """run() is the chain of its stages; in other partitions it gives the same pieces, and no stage's
    table but the last is left behind."""
    def chain(parts):
        docs = cp.read(llm_spark, folder, "documents").repartition(parts)
        kept = []
        for _, stage in cp.STAGES[:-1]:
            docs = stage(llm_spark, docs, folder)
            kept.append(tuples(docs))
            docs = llm_spark.createDataFrame(kept[-1], docs.schema).repartition(parts)
        return kept, docs
    first, mixed = chain(2)
    llm_spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        second, _ = chain(7)
    finally:
        llm_spark.conf.set("spark.sql.shuffle.partitions", "8")
    for a, b in zip(first, second):
        same(a, b)
    final = cp.run(llm_spark, folder)
    tok = Tokenizer.from_str(open(VOCABULARY.json).read())
    want = []
    for r in first[-1]:
        ids = np.array([*tok.encode(r[1], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(piece_lengths(len(ids), 2048)):
            want.append((r[0], k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
    check_packing(final.collect(), want)
    at = final.inputFiles()[0].rsplit("/", 2)
    jvm = llm_spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at[0])
    fs = path.getFileSystem(llm_spark.sparkContext._jsc.hadoopConfiguration())
    assert [x.getPath().getName() for x in fs.listStatus(path)] == [at[1]] == ["4"]


def test_empty_tables(llm_spark, tmp_path):
    at = str(tmp_path)
    llm_spark.createDataFrame([], COLUMNS).write.parquet(f"{at}/documents.parquet")
    llm_spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    assert cp.run(llm_spark, at).count() == 0


def test_fingerprint_is_the_contract():
    assert brute_fp("a b c d") == xxhash.xxh64_intdigest(b"a b c d", 42)
    assert json.loads(open(VOCABULARY.json).read())["model"]["type"] == "BPE"
    assert F.lit(1) is not None
