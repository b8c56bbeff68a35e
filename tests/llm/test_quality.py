import random

import numpy as np
import pytest

from stockflow.llm.quality import N_FEATURES, features, keep_good, score_quality, site_posteriors


def corpus():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        good = int(i % 5 != 0)
        words = [rng.choice(vocab) for _ in range(rng.randrange(30, 90))]
        text = " ".join(words) if good else rng.choice([" ".join([words[0]] * 60), "!! ".join(words).upper()])
        rows.append((i, text, f"s{i % 7}" if i % 11 else None))
        if i % 2:
            labels.append((i, good, 0))
    return rows + [(900, None, None), (901, "", "s1"), (902, "long text of words " * 9000, "only"), (None, rows[1][1], "s1"),
                   (1, rows[1][1], "s1")], labels


def test_held_out_accuracy_and_odd_rows(make_docs, llm_spark):
    rows, labels = corpus()
    lab = llm_spark.createDataFrame(labels + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    out = score_quality(docs, lab)
    got = out.collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 2 == 0]
    assert np.mean([r.keep == (r.doc_id % 5 != 0) for r in held]) > 0.97
    kept = keep_good(docs, out)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in got if not r.keep}
    assert kept.count() == sum(r[0] not in bad for r in rows)
    assert score_quality(docs, lab.limit(0)).filter("keep").count() == len(rows)
    assert score_quality(make_docs([]), lab).count() == 0


def test_sparse_sites_shrink(llm_spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.1)] * 400 + [("poor", "a", 0.1)] * 300 + [("one", "a", 0.0)] + [("good", None, 1.0)] * 300
    post = {(r.host, r.path): r for r in site_posteriors(llm_spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    corpus = sum(p for *_, p in rows) / len(rows)
    assert post["big", "a"].path_mean > 0.8 and post["big", "b"].path_mean < 0.2
    assert abs(post["big", "a"].host_mean - 0.5) < 0.05
    lone = post["one", "a"]
    assert 0 < lone.path_mean <= lone.host_mean < corpus and lone.path_mean > 0.01
    assert post["good", None].path_mean == pytest.approx(1, abs=0.05)


def test_features_are_finite():
    for t in (b"", b" ", b"a", b"\n\n", "é".encode() * 50):
        x = features(t)
        assert len(x) == N_FEATURES and np.isfinite(x).all()


def test_rows_are_judged_each_on_its_own(make_docs, llm_spark):
    rows, labels = corpus()
    lab = llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [r for r in rows if r[0] is not None and r[0] < 400]
    rows += [(None, rows[k][1], "s1") for k in range(40)] + [(7000, rows[k][1], "s2") for k in range(40)]
    docs = make_docs(rows)
    scores = score_quality(docs, lab)
    kept = keep_good(docs, scores).select("doc_id", "text").collect()
    want = [(r.doc_id, r.keep) for r in scores.collect()]
    for i in (None, 7000):
        assert 20 < sum(k for d, k in want if d == i) == sum(r.doc_id == i for r in kept) < 40
    assert len(kept) == sum(k for _, k in want)
