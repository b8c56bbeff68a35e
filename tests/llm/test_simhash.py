import random

import numpy as np
import xxhash

from stockflow.llm.simhash import bk_links, fingerprint, keep_one, simhash_groups


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius):
    lab = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and lab[i] != lab[j]:
                    lab[i] = lab[j] = min(lab[i], lab[j])
                    changed = True
    return lab


def test_bk_trees_find_every_group():
    rng = random.Random(3)
    fps = []
    for _ in range(30):
        c = rng.getrandbits(64)
        fps += [c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for _ in range(6)]
    fps = sorted(set(fps))
    for shards in (1, 3):
        shard = np.arange(len(fps)) * shards // len(fps)
        u, v = bk_links(np.array(fps, np.uint64), shard, 4)
        got = np.arange(len(fps))
        got[u] = v
        want = []
        for s in range(shards):
            at = np.flatnonzero(shard == s)
            want += [at[0] + x for x in brute_groups([fps[i] for i in at], 4)]
        assert got.tolist() == want


def corpus():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(120)]
        rows.append((i, " ".join(words)))
        for j in range(i % 4):
            near = list(words)
            near[rng.randrange(120)] = "changed"
            rows.append((1000 + 10 * i + j, "\n".join(near).upper() if j else " ".join(near)))
    rows += [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "ONE  two"), (505, "x " * 20000),
             (39, rows[0][1]), (39, rows[0][1]), (None, rows[5][1]), (None, "alone in its group")]
    return rows


def test_groups_by_brute_force(make_docs):
    rows = corpus()
    fps = [brute_fp(t) for _, t in rows]
    lab = brute_groups(fps, 4)
    low = {}
    for (i, _), g in zip(rows, lab):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    want = sorted(((i, f"{f:016x}", low.get(g)) for (i, _), f, g in zip(rows, fps, lab)), key=str)
    docs = make_docs(rows)
    for shard_rows in (2048, 3):                     # 3: the second split of large shards
        from stockflow.llm import simhash
        old, simhash.SHARD_ROWS = simhash.SHARD_ROWS, shard_rows
        simhash.hamming_links.__defaults__ = (shard_rows,)
        got = simhash_groups(docs)
        assert sorted(map(tuple, got.collect()), key=str) == want
        simhash.SHARD_ROWS = old
        simhash.hamming_links.__defaults__ = (old,)
    kept = keep_one(docs, got).collect()
    assert len(kept) == len(set(lab))
    assert simhash_groups(make_docs([])).count() == 0


def test_fingerprint_small():
    for t in ("", "a", "a b c d", "a b c d e f g a b c d"):
        assert fingerprint(t.encode().split(), 4) == brute_fp(t)


def test_one_row_of_each_group_under_null_and_repeated_ids(make_docs):
    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(80))
    rows = [(None, text()), (None, text()), (None, text()), (7, text()), (7, text()), (8, text())]
    rows += [rows[0]] * 3 + [(None, rows[5][1]), (9, rows[1][1]), (8, rows[5][1]), (None, None), (None, "")]
    lab = brute_groups([brute_fp(t) for _, t in rows], 4)
    kept = sorted(((r.doc_id, r.text) for r in keep_one(make_docs(rows)).collect()), key=str)
    by = {r: g for r, g in zip(rows, lab)}
    assert sorted(by[r] for r in kept) == sorted(set(lab)) and len(set(lab)) == 7
    low = lambda g: min((r[0] is None, r[0] or 0) for r in rows if by[r] == g)
    assert all((i is None, i or 0) == low(by[i, t]) for i, t in kept)
    assert sorted(((r.doc_id, r.text) for r in keep_one(make_docs(rows[::-1])).collect()), key=str) == kept
