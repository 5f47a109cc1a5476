"""Signatures against a plain SuperMinHash, and groups against all pairs."""

import random
import re

import numpy as np
import pytest

from wardlight.llm import near_duplicates as N
from wardlight.llm import shingles as S


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_set(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_force(rows, percent):
    """doc_id -> smallest id reachable, by comparing every pair."""
    sets = [(i, plain_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if x and y and a < b and 100 * len(x & y) >= percent * len(x | y):
                one, two = sorted((top(a), top(b)))
                root[two] = one
    return {i: top(i) for i in root}


def changed(rnd, text, n):
    out = text.split(" ")
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"w{rnd.randrange(10**6)}"
    return " ".join(out)


def corpus(seed=1, family=60, length=120):
    """Random texts, copies, and families whose members drift away from each other in steps."""
    rnd = random.Random(seed)
    new = lambda n: " ".join(f"v{rnd.randrange(500)}" for _ in range(n))
    texts = [new(rnd.randrange(1, 200)) for _ in range(40)]
    texts += [texts[3], texts[3].upper(), texts[5], "  " + texts[5].replace(" ", "\t\n")]
    base = new(length)
    texts += [changed(rnd, base, rnd.randrange(6)) for _ in range(family)]
    step = new(length)
    for _ in range(25):
        texts.append(step)
        step = changed(rnd, step, 1)
    texts += ["", None, " \t\n", "one two", "One  two", "a b c d e", "a b c d e f"]
    rnd.shuffle(texts)
    return [(i * 3 % 997, t) for i, t in enumerate(texts)]


def test_sets_hold_the_shingles_of_the_words():
    texts = [t or "" for _, t in corpus()] + ["x\x1cy z\xa0w q r s", "É é A-b C_d e f g"]
    for text, found in zip(texts, S.shingle_sets([t.encode() for t in texts]), strict=True):
        assert len(found) == len(plain_set(text))
    a, b = S.shingle_sets([b"p q r s t u v", b"zz P Q R S T u w"])
    assert len(np.intersect1d(a, b)) == 2


def test_signatures_are_superminhash():
    rnd = np.random.default_rng(4)
    sets = [rnd.integers(0, 1 << 63, n, np.uint64) for n in (0, 1, 7, 40, 500)]
    m = 32
    found = S.super_min_hash(sets, m)
    for elements, mine in zip(sets, found, strict=True):
        expected = [int(S.EMPTY)] * m
        for x in elements:
            order = list(range(m))
            for j in range(m):
                fraction, place = S._draw(np.array([x], np.uint64), j, m)
                k = int(place[0])
                order[j], order[k] = order[k], order[j]
                expected[order[j]] = min(expected[order[j]], (j << 48) + int(fraction[0]))
        assert expected == [int(v) for v in mine]


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(5)
    errors = []
    for _ in range(80):
        a = rnd.integers(0, 1 << 63, 300, np.uint64)
        b = np.concatenate([a[:270], rnd.integers(0, 1 << 63, 30, np.uint64)])
        x, y = S.super_min_hash([a, b], N.PLACES)
        errors.append((x == y).mean() - 270 / 330)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_bands_lose_next_to_no_pair():
    for percent in (70, 80, 85, 95):
        rows = N.rows_per_band(percent)
        assert (1 - (percent / 100) ** rows) ** (N.PLACES // rows) <= N.LOST


@pytest.mark.parametrize("percent", [85, 70])
def test_groups_are_those_of_all_pairs(spark, percent):
    rows = corpus()
    df = spark.createDataFrame([(*r, 5, True) for r in rows], "doc_id bigint, text string, n_shingles int, kept boolean")
    out = {r["doc_id"]: r for r in N.group_near_duplicates(df, percent=percent).collect()}
    expected = brute_force(rows, percent)
    assert {i: r["component_id"] for i, r in out.items()} == expected
    for i, text in rows:
        assert out[i]["n_shingles"] == len(plain_set(text)) and out[i]["kept"] == (expected[i] == i)


def test_small_blocks_and_samples_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "AGAINST", 32)
    monkeypatch.setattr(N, "SAMPLED", 1024)
    rows = corpus(seed=2, family=120, length=80)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r["component_id"] for r in N.group_near_duplicates(df).collect()}
    assert out == brute_force(rows, 85)


def test_close_pairs_find_all_links_of_sampled_sets():
    rnd = np.random.default_rng(6)
    base = rnd.integers(0, 1 << 64, 3000, np.uint64)
    sets = []
    for part in (0, 60, 150, 240, 700):
        own = np.concatenate([base[part:], rnd.integers(0, 1 << 64, part, np.uint64)])
        sets.append(np.sort(own))
    ids = np.arange(5) * 10
    both = np.concatenate([np.ones(5, bool), np.zeros(5, bool)])
    held = [N.sample(s).tobytes() for s in sets] * 2
    pairs = N.close_pairs(np.tile(ids, 2), np.tile(ids, 2), np.array([3000] * 10), held, both, 85)
    found = {tuple(p) for p in pairs.tolist()}
    for i in range(5):
        for j in range(i + 1, 5):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 85 * (6000 - shared):
                assert (ids[i], ids[j]) in found
    assert (0, 40) not in found


def test_edge_rows(spark):
    text = "a b c d e f g h"
    rows = [(4, text), (4, text), (2, text.upper()), (None, text), (None, "only here in the null row"), (9, None), (8, "")]
    out = N.group_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["n_shingles"] != 2)
    assert found == [(-1, 4, 2, False), (2, 4, 2, True), (4, 4, 2, False), (4, 4, 2, False), (8, 0, 8, True), (9, 0, 9, True)]
    assert [(r["component_id"], r["kept"]) for r in out if r["n_shingles"] == 2] == [(None, False)]
    assert N.group_near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    kept = N.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or -1) for r in kept) == [-1, -1, 2, 8, 9]
