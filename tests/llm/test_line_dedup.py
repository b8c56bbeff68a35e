"""Operator 11 against a brute-force version."""

import hashlib
import random

import pytest

from stockflow.llm import line_dedup
from stockflow.llm.line_dedup import remove_shared_lines

BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)


def brute(rows, min_chars=40, min_docs=5):
    lines = [(r[1] or "").split("\n") for r in rows]
    keys = [[x.strip(BLANKS).translate(FOLD) for x in ls] for ls in lines]
    held = {}
    for r, ks in zip(rows, keys):
        for k in set(ks):
            if len(k) >= min_chars:
                held.setdefault(k, []).append(r[0])
    holder = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for r, ls, ks in zip(rows, lines, keys):
        kept = [x for x, k in zip(ls, ks) if k not in holder or holder[k] == r[0]]
        text = "\n".join(kept)
        out.append((r[0], len(ls), len(ls) - len(kept), hashlib.sha256(text.encode()).hexdigest(), text))
    return out


def common(k):
    return f"Shared line number {k}, LONG enough to be a key of its own."


def sample():
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        body = [f"own line {i} {j} " + "x" * rnd.randint(0, 50) for j in range(rnd.randint(0, 6))]
        for k in range(8):
            if rnd.random() < k / 8:
                c = common(k)
                body.insert(rnd.randint(0, len(body)), rnd.choice([c, c.upper(), "\t " + c + " \r", c.lower() + "\x0b"]))
        rows.append((i, "\n".join(body)))
    hot = common(99)
    rows += [(100 + i, f"{hot}\nown {i}\n{hot}\n") for i in range(40)]                 # a third of all rows, twice each
    rows += [(None, hot), (None, hot + "\nz"), (7, rows[7][1]), (7, common(3) + "\nother text"), (None, None), (3, ""), (4, "\n\n"),
             (200, "É" * 39 + "é"), (201, "É" * 40), (202, "É" * 40), (203, "É" * 40), (204, "É" * 40), (205, "é" * 40), (206, "É" * 40),
             (207, " " + "É" * 40), (300, "\n".join(f"line {j} {common(j % 9)}" for j in range(5000)) + "\n" + common(5))]
    rows += [(None, "only null ids hold this line, which is long enough")] * 6
    return rows


def test_brute_force(make_docs):
    rows = sample()
    got = remove_shared_lines(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)
    assert any(r.n_dropped for r in got)


@pytest.mark.parametrize("parts", [1, 10 ** 9])
def test_heavy_and_light_keys_agree(make_docs, monkeypatch, parts):
    """No key heavy, or every key: the same rows."""
    monkeypatch.setattr(line_dedup, "HEAVY_PARTS", parts)
    rows = sample()
    got = remove_shared_lines(make_docs(rows), min_docs=3).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, min_docs=3), key=repr)


def test_empty_table(make_docs):
    assert remove_shared_lines(make_docs([])).count() == 0
    assert remove_shared_lines(make_docs([(1, None)])).collect()[0][:3] == (1, 1, 0)
