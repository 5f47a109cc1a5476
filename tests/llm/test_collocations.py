"""Collocations against brute force; transducers against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardlight.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute_force(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text):
            n[lang or "und"] += len(ws)
            for size in range(1, 5):
                f[lang or "und"].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, b in some.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * b >= 80 * some[p[i:j]]}
        scored = []
        for p, a in some.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def text(rnd, words, size):
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]
    return "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(size))


def made(spark, rows, least, top):
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "lang string, text string, a int, phrase string")
    return sorted(tuple(r) for r in C.collocations(df, least=least, top=top).collect())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    words = ["the", "The", "of", "é😀", "ﬀ", "Z", "zz", "\x00", "\x1c", "a\xa0b", "ÀB", "𐐀"]
    out = [(rnd.choice(["en", "en", "en", "de", None]), text(rnd, words, rnd.randrange(120))) for _ in range(60)]
    out += [("en", text(rnd, words[:3], 4000))]  # one long text, nearly one phrase after the other
    out += [("en", None), ("en", ""), ("fr", " \t\n.,"), ("und", "q r s t " * 40), (None, "q r s t " * 3)]
    return out + [("en", "of the one and only thing")] * 40


def test_is_what_brute_force_gives(spark, rows):
    assert made(spark, rows, 8, 50) == brute_force(rows, 8, 50)


def test_cuts_of_shards_and_ranges_change_nothing(spark, rows, monkeypatch):
    for name, value in {"SHARD_WORDS": 37, "SLICE": 11, "RANGE_ARCS": 300}.items():
        monkeypatch.setattr(C, name, value)
    assert made(spark, rows, 8, 1000) == brute_force(rows, 8, 1000)


def test_no_rows_without_candidates(spark, rows):
    assert made(spark, [], 30, 5) == [] and made(spark, [(None, None), ("en", "a b")], 30, 5) == []


def test_shards_read_texts_whole():
    rnd = random.Random(2)
    for _ in range(200):
        texts = [("x", text(rnd, ["a", "b", "cc"], rnd.randrange(30))) for _ in range(3)]
        found, want = Counter(), Counter()
        for _, t in texts:
            for ws in pieces(t):
                want.update(tuple(ws[i : i + n]) for n in (2, 3, 4) for i in range(len(ws) - n + 1))
        total = 0
        for _, shard in C.read_shards(((x, t.encode()) for x, t in texts), rnd.randrange(1, 9), rnd.randrange(1, 9)):
            words = [None, *(w.decode() for w in shard.numbers)]
            total += shard.counts().sum()
            paths, weights = C.Transducer.from_words(np.array(shard.seq, np.int64), shard.context).paths()
            for p, w in zip(paths, weights):
                found[tuple(words[i] for i in p if i)] += int(w)
        assert found == want and total == sum(len(ws) for _, t in texts for ws in pieces(t))


def as_dict(made):
    return {tuple(p[p > 0].tolist()): int(w) for p, w in zip(*made.paths())}


def test_transducers():
    rng = np.random.default_rng(4)
    seqs = [rng.integers(0, 6, 300) for _ in range(5)]
    parts = [C.Transducer.from_words(s, 0) for s in seqs]
    total = Counter()
    for p in parts:
        total.update(as_dict(p))
    whole = C.Transducer.union([C.Transducer.load(*p.dump()) for p in parts])
    assert as_dict(whole) == total
    assert as_dict(whole.at_least(7)) == {p: n for p, n in total.items() if n >= 7}
    cut = [t for s in seqs for _, t in C.cut_shard(s, 0, np.arange(1, 6), np.array([1, 3, 1, 9, 1]), 7, 5)]
    assert as_dict(C.Transducer.union(cut)) == total
    asked = np.unique(rng.integers(1, 8, (50, 4)) * (np.arange(4) < rng.integers(2, 5, (50, 1))), axis=0)
    request = C.Transducer.build(asked, np.ones(len(asked), np.int64))
    paths, _ = request.paths()
    answer = np.concatenate([c[w > 0] for c, w in zip(request.compose(whole), request.weight)])
    assert {tuple(p[p > 0].tolist()): n for p, n in zip(paths, answer.tolist())} == {
        tuple(p[p > 0].tolist()): total.get(tuple(p[p > 0].tolist()), 0) for p in asked
    }
    empty = C.Transducer.build(np.zeros((0, 4), np.int64), np.zeros(0, np.int64))
    assert not as_dict(empty) and not sum(c.sum() for c in request.compose(empty))
