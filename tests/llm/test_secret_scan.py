import hashlib
import random
import re
from dataclasses import replace

import numpy as np

from stockflow.llm import secret_scan
from stockflow.llm.secret_scan import (WIDTH, CharCNN, encode, redact, redact_documents, scan, scan_secrets, survey,
                                       train_cnn, windows)

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def corpus():
    rng = random.Random(6)
    hexs = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(240):
        t = " ".join(rng.choice(["één", "word", "longerword", "x"]) for _ in range(20))
        t += rng.choice([f' token = "{hexs(40)}" ', f" Password: {hexs(12)} ", " AKIA" + "Q7" * 8 + " ",
                         " invoice-number-2024-0001-aaaa ", " file_name_version_1.2.3.txt ", " http/path/1/two/three "])
        rows.append((i, t + "tail"))
    return rows + [(900, None), (901, ""), (902, "SECRET=ab password='abcdef0123' passwd : kſ token==--AKIA" + "A" * 30),
                   (903, "abcdef0123" * 9000), (904, "ſecret=abcdefgh apikey=aaaaaaa"), (3, rows[3][1]), (None, rows[4][1]),
                   (905, "f" * 24), (906, "F" + "0" * 23), (907, "x" * 16), (908, "é" * 30 + "api_key=zzzzzz")]


def test_rules_by_brute_force(make_docs):
    rows = corpus()
    got = scan_secrets(make_docs(rows)).collect()
    want = [(i, brute(t or "")) for i, t in rows]
    base = lambda s: ",".join(x for x in s.split(",") if x and not x.startswith("cnn"))
    assert sorted(((r.doc_id, base(r.spans)) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(base(r.spans).encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len([x for x in base(r.spans).split(",") if x])
    assert scan_secrets(make_docs([])).count() == 0
    assert scan_secrets(make_docs([(1, "plain")])).first().spans == ""


def test_redaction_keeps_columns_and_rows(make_docs):
    docs = make_docs(corpus())
    out = redact_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert r.text is None or (brute(r.text) == "" and r.n_chars == len(r.text))
    assert redact("a token=abcdef b", "assign:2:14,hex:4:10") == "a [SECRET] b"


def test_network_learns_held_out_findings():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        secret = i % 2
        value = "".join(rng.choice("0123456789abcdef") for _ in range(32)) if secret else "report-2024-section-12-of-the-text"
        left = rng.choice(["token = ", "see also ", "key: "])
        text = f"some words {left}{value} more".encode()
        at = text.index(value.encode())
        rows += windows(text, at, at + len(value))[:1]
        labels.append(secret)
    x, y = encode(rows), np.array(labels)
    net = train_cnn(x[:600], y[:600])
    accepted = net.score(x[600:]) >= net.threshold
    assert (accepted == (y[600:] == 1)).mean() > 0.95
    assert train_cnn(x[:600], np.ones(600, int)) is None and x.shape[1] == WIDTH and isinstance(net, CharCNN)
    assert list(scan([b"", b"abc"])) == [([], []), ([], [])]


def test_recall_without_keywords_among_many_others():
    rng = random.Random(4)
    hexs = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    plain = ["see also ", "some words then ", "as listed in ", "the file "]

    def row(left, value):
        text = f"some more words {left}{value} tail".encode()
        return windows(text, text.index(value.encode()), text.index(value.encode()) + len(value))[0]

    rows, labels = [], []
    for i in range(3600):                   # one finding to 17 others, of which a third look the same
        secret = i % 18 == 0
        value = hexs(32) if secret or i % 3 == 1 else f"report-2024-section-{i:04d}-text"
        rows.append(row("token = " if secret else rng.choice(plain), value))
        labels.append(int(secret))
    order = rng.sample(range(len(rows)), len(rows))
    net = train_cnn(encode([rows[k] for k in order]), np.array([labels[k] for k in order]))
    unseen = encode([row(rng.choice(plain), hexs(32)) for _ in range(400)])
    assert (net.score(unseen) >= net.threshold).mean() > 0.9
    assert net.threshold < 0.5


def test_every_run_reaches_the_network(make_docs):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = ["", "pwd: hunter22 Bearer abcdefghijkl", "é" * 9 + " auth='qwerty' x=1", "a" * 37, "b" * 36 + " " + "c" * 35,
             "token=" + word(30), "x" * 400 + "1", "secret : abcdef tail-of-text"]
    texts += [" ".join(word(rng.randrange(1, 45)) for _ in range(60)) for _ in range(30)]
    spans, c = survey([t.encode() for t in texts])
    got = sorted(zip(c.doc.tolist(), (c.start - c.first[c.doc]).tolist(), (c.end - c.first[c.doc]).tolist()))
    assert got == sorted((d, m.start(), m.end()) for d, t in enumerate(texts)
                         for m in re.finditer(rb"[A-Za-z0-9+/_.=-]{6,}", t.encode()))
    by = {(d, bytes(texts[d].encode()[s:e])): y for (d, s, e), y in zip(got, c.label.tolist())}
    assert by[1, b"hunter22"] == by[1, b"abcdefghijkl"] == by[2, b"qwerty"] == 0
    assert by[7, b"secret"] == 2 and by[7, b"abcdef"] == 1
    x = encode([windows(texts[d].encode(), s, e)[0] for d, s, e in got])
    y = rng.choices((0, 1), k=len(x))
    net = train_cnn(x, np.array(y), epochs=1)
    want = [net.score(encode(windows(texts[d].encode(), s, e))).max() for d, s, e in got]
    assert np.allclose(net.run_scores(c, np.arange(len(got))), want, atol=1e-4)

    # values without digits, without any keyword
    letters = lambda n: "".join(rng.choice("QXZJKVWqxzjkvw") for _ in range(n))
    plain = lambda n: " ".join(rng.choice(["meadow", "window", "little", "forest", "summer", "garden"]) for _ in range(n))
    rows = [(i, f"{plain(20)} token: {letters(9)} {plain(5)}" if i % 2 else plain(25)) for i in range(400)]
    rows += [(1000 + i, f"{plain(20)} {letters(9)} {plain(5)}") for i in range(60)]
    out = {r.doc_id: r for r in scan_secrets(make_docs(rows)).collect()}
    hit = sum(f"cnn:{re.search('[QXZJKVWqxzjkvw]{9}', t).start()}:" in out[i].spans for i, t in rows[400:])
    assert hit > 50 and sum(out[i].n_cnn for i in range(0, 400, 2)) < 100


def test_every_candidate_trains_or_calibrates(make_docs, monkeypatch):
    rows = corpus()
    steps, bins = [], []
    corpus_step, platt = secret_scan._corpus_step, secret_scan.platt

    def step(*args):
        steps.append(corpus_step(*args))
        return steps[-1]

    monkeypatch.setattr(secret_scan, "_corpus_step", step)
    monkeypatch.setattr(secret_scan, "platt", lambda z, t, n: bins.append((t, n)) or platt(z, t, n))
    docs = make_docs(rows).repartition(5)
    net = secret_scan.fit(docs, "text", rows=30)         # the first steps see 30 candidates of each label
    c = survey([(t or "").encode() for _, t in rows])[1]
    held = [secret_scan._is_held(secret_scan._hashes(c.windows(np.flatnonzero(c.label == y)))) for y in (0, 1)]
    assert min(h.sum() for h in held) > 30
    counts = np.array(steps)[:, :, -1].sum(0)
    assert counts.tolist() == [(~held[0]).sum(), 2 * (~held[1]).sum()]     # findings with and without keyword
    t, n = bins[-1]
    assert [n[t == y].sum() for y in (0, 1)] == [h.sum() for h in held]
    again = secret_scan.fit(docs.repartition(2), "text", rows=30)
    assert np.array_equal(again.conv, net.conv) and again.threshold == net.threshold


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    net = CharCNN(rng.normal(0, .3, (256, 8)), rng.normal(0, .2, (40, 24)), rng.normal(0, .1, 24), rng.normal(0, .3, (48, 1)), -.5)
    text = " ".join("".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(6, 60))) for _ in range(200)).encode()
    c = survey([text])[1]
    x = c.windows(np.arange(len(c.start)))
    sums = secret_scan.gradient(net, x, 0)
    assert sums[-1] == len(x)
    assert np.allclose(np.concatenate([net.pooled_logits(p)[2] for p in secret_scan.packed(x)]).sum(), net.logit(x).sum(), rtol=1e-3)
    got = secret_scan._by_weight(net, np.array([sums, np.zeros_like(sums)]))
    for name in ("embed", "conv", "bias", "head"):
        at = np.unravel_index(np.abs(got[name]).argmax(), got[name].shape)
        loss = []
        for d in (1e-5, -1e-5):
            w = getattr(net, name).copy()
            w[at] += d
            loss.append(np.log1p(np.exp(replace(net, **{name: w}).logit(x))).sum())
        assert np.isclose((loss[0] - loss[1]) / 2e-5 / len(x) / 2, got[name][at], rtol=1e-2)


def test_no_bounded_set_of_candidates_trains(make_docs):
    docs = make_docs(corpus())
    few, many = (secret_scan.fit(docs, "text", rows=n) for n in (7, 6000))
    for name in ("embed", "conv", "bias", "head", "shift", "scale", "offset", "threshold"):
        assert np.array_equal(getattr(few, name), getattr(many, name))


def test_hidden_findings_get_a_context_without_findings():
    texts = [b"", b"token=abcdef0123456789", b"some other words that are longer here token: abcdef0123 and afterwards more words follow"]
    got = list(secret_scan.folds(texts, 2, False)) + list(secret_scan.folds(texts, 2, True))
    hidden = np.concatenate([z for y, _, z in got if y])
    plain = np.concatenate([x for y, x, _ in got if not y])
    assert len(hidden) == 2 and len(plain) == sum(c == 0 for c in survey(texts)[1].label)
    for w in hidden[:, :secret_scan.LEFT]:
        assert b"token" not in w.tobytes() and b"abcdef" not in w.tobytes()
        assert w.tobytes() == b"\n" * secret_scan.LEFT or any(np.array_equal(w, p[:secret_scan.LEFT]) for p in plain)


def test_bound_loses_no_candidate():
    rng = np.random.default_rng(3)
    text = " ".join("".join(chr(k) for k in rng.choice(list(b"abcdef0123XYZ=/"), rng.integers(1, 60))) for _ in range(600)).encode()
    c = survey([text, b"", b"n\xc3\xa9e " + text[::-1]])[1]
    k = np.flatnonzero(c.label == 0)
    for spread in (.1, 1., 6.):
        net = CharCNN(rng.normal(0, spread, (256, 8)), rng.normal(0, .2, (40, 24)), rng.normal(0, .1, 24), rng.normal(0, .3, (48, 1)), -.5)
        score = net.run_scores(c, k)
        for scale, offset, threshold in ((1., 0., np.quantile(score, .9)), (3., -50., 1.), (3., 60., 1.), (-1., 0., .5),
                                         (1., 0., 0.), (1., 0., 2.), (.2, .3, np.quantile(score, .5))):
            other = replace(net, scale=scale, offset=offset, threshold=float(threshold))
            passes = other.run_scores(c, k) >= other.threshold
            may = other.may_pass(c, k)
            assert (may | ~passes).all()
        short = c.end[k] - c.start[k] <= 30
        sharp = replace(net, threshold=float(np.quantile(score, .99)))
        assert sharp.may_pass(c, k)[short].mean() < .9       # and it spares some their exact score
