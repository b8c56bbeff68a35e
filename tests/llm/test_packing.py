import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from stockflow.llm.queries import VOCABULARY
from stockflow.llm.packing import CachedEncoder, best_fit_pack, sum_of_squares

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "a \n b", "a  b", "x   y z", "it's  we'll",
       "<|endoftext|> a <|endoftext|>", "a\t\tb  c\n\n d", "é ü 漢字 🙂 b", "\n", "a \n \n b", "a\n \nb", "a\n \u00a0b", "\u00a0 b", "a\u00a0 b", "a\x1c b \x1cc", "1234 567!! ??"]


def test_cached_ids_are_the_tokenizers():
    tok = Tokenizer.from_file(PATH)
    enc = CachedEncoder(VOCABULARY, cache_words=4)
    for _ in range(2):
        got = [x.tolist() for x in enc.encode(ODD)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in ODD]


def test_sum_of_squares_choices_by_brute_force():
    rng = np.random.default_rng(5)
    cap = 40
    lengths = rng.integers(1, cap + 1, 300)
    b, off = sum_of_squares(lengths, cap)
    gaps: dict[int, int] = {}
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])

        def cost(after):
            n = np.bincount([g for g in after.values() if g], minlength=cap + 1)
            return int((n * n).sum())
        fits = {k: cost({**gaps, k: g - s}) for k, g in gaps.items() if g >= s}
        if fits:
            assert fits[int(b[i])] == min(fits.values())
            assert off[i] == cap - gaps[int(b[i])]
            gaps[int(b[i])] -= s
        else:
            assert int(b[i]) not in gaps and off[i] == 0
            gaps[int(b[i])] = cap - s


def test_packing_round_trip(make_docs):
    tok = Tokenizer.from_file(PATH)
    rows = [(1, "hello world"), (2, None), (3, ""), (4, "long word " * 700), (4, "hello world"), (None, "x"),
            (5, "a  b"), (6, "hello world"), (6, "hello world")]
    cap = 256
    out = best_fit_pack(make_docs(rows), VOCABULARY, capacity=cap, group_pieces=5).collect()
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % cap if len(ids) > cap else len(ids)
        cuts = [0, *([first] if first else []), *range(first + cap, len(ids) + 1, cap)]
        for k, (a, e) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, e - a, zlib.crc32(np.array(ids[a:e], "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in out], key=str) == sorted(want, key=str)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in by.values():
        x.sort()
        assert [o for o, _ in x] == list(np.cumsum([0] + [n for _, n in x])[:-1])
        assert sum(n for _, n in x) <= cap
    assert best_fit_pack(make_docs([]), VOCABULARY).count() == 0
