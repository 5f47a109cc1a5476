"""Quality rules, license scans and top-k search against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import licenses as S
from wardlight.llm import quality as Q
from wardlight.llm import top_k as K


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counts(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    inside = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(inside)


CLEAN = "The quick brown fox jumps over the lazy dog, and then it goes home to sleep until the next morning comes around."
TEXTS = [
    CLEAN,
    CLEAN + "\n" + CLEAN,
    "a b c d e f g h " * 12,
    "x\x1cy z\xa0w \x0b\x0c é😀 # * $ % & | < >\n\n  \nq\nq \nq",
    "word " * 3000 + CLEAN,
    CLEAN.upper() + " " + CLEAN.upper().replace("FOX", "CAT"),
    " ".join(w + "%%%" for w in CLEAN.split()),
    "one two three four five six seven eight nine ten " * 2 + "one two three four five six seven eight",
    "",
    " \t\n",
    None,
]


def test_features_are_those_of_brute_force(spark):
    rnd = random.Random(7)
    made = [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) for _ in range(60)]
    rows = [(i, t, 1, 2) for i, t in enumerate(TEXTS + made)] + [(None, CLEAN, 0, 0), (0, CLEAN, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, kept int")
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    out = [(r["row"]["doc_id"], *[r[n] for n in names]) for r in Q.features(df).collect()]
    assert sorted(out, key=str) == sorted([(i, *counts(t)) for i, t, *_ in rows], key=str)


def test_the_verdict_does_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, place int")
    judged = {r["row"]["doc_id"]: r for r in Q.judge(df).collect()}
    kept = {i for i, r in judged.items() if r["kept"]}
    assert kept == {0}
    assert [judged[i]["base_failed"] for i in (2, 7, 8, 10)] == [True] * 4 and not judged[6]["base_failed"]
    for order in (Q.RULES, Q.RULES[::-1]):
        found = Q.features(df).withColumn("by", Q.cascade([*Q.BASE_RULES, *order]))
        assert {r["row"]["doc_id"] for r in found.filter("by is null and place >= 0").collect()} == kept
    assert {r["doc_id"] for r in Q.drop_rejected(df).collect()} == kept
    assert Q.drop_rejected(df).columns == df.columns
    assert Q.judge(df.limit(0)).collect() == []


def test_rules_are_ranked_by_rejection_for_their_cost(spark):
    sample = Q.features(spark.createDataFrame([(i, CLEAN) for i in range(50)], "doc_id bigint, text string")).persist()
    rules = (Q.Rule("never", "n_words < 0"), Q.Rule("always", "n_words >= 0"), Q.Rule("costly", "n_words < 0 and length(sha2(repeat(text, 500), 512)) > 0"))
    assert Q.rank_rules(sample, rules)[0].name == "always"
    sample.unpersist()


def license_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
LICENSED = [
    ("Released under the MIT License. See Apache  license\nand CC-BY, cc by.", {"mit", "apache", "cc-by"}, set()),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl"}, {"gpl-3.0"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by"}, {"cc-by-nc-4.0"}),
    ("before " + NOTICE + " behind", set(), {"mit"}),
    ("x " + NOTICE.replace("free of charge", "free of any charge").replace("obtaining", "getting"), set(), {"mit"}),
    ("This work is licensed under the GNU General Public License version 2", {"gpl"}, set()),  # another version is another license
    ("licensed under the Apache License, Version 2.0", {"apache"}, {"apache-2.0"}),
    ("licensed under the Apache License, Version 2.1", {"apache"}, set()),
    ("licensed under the Apache License, Version 20", {"apache"}, set()),
    ("licensed under CC BY-NC 4.1 or CC BY 4.0", {"cc-by"}, set()),
    ("licensed under a Creative Commons Attribution ShareAlike 4.0 International License", set(), {"cc-by-sa-4.0"}),
    ("licensed under a Creative Commons Attribution NoDerivatives 3.0 International License", set(), set()),
    ("this program is free software you can redistribute it " * 4, set(), set()),  # a part, however often
    ("mit. gnu general license public; apachelicense, MİT LICENSE mitK license", set(), set()),
    ("mit license " * 3000, {"mit"}, set()),
    ("", set(), set()),
    (None, set(), set()),
    ("license", set(), set()),
]


def test_licenses(spark):
    rows = [(i, t, 0.5, "x") for i, (t, *_) in enumerate(LICENSED)] + [(None, LICENSED[0][0], 1.0, "y"), (0, LICENSED[0][0], 1.0, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score double, labels string")
    out = S.scan(df).collect()
    assert len(out) == len(rows)
    by_text = {t: (b, o) for t, b, o in LICENSED}
    expected = []
    for doc_id, text, *_ in rows:
        w = license_words(text)
        starts = [i for t in S.TEMPLATES if t.phrase for i in range(len(w)) if w[i : i + len(t.text.split())] == t.text.split()]
        base, own = by_text[text]
        labels = ",".join(sorted(base | own))
        expected.append((doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), labels))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    assert sorted([tuple(r[n] for n in names) for r in out], key=str) == sorted(expected, key=str)
    assert all(0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(r["base_labels"]) for r in out)
    assert S.scan(df.limit(0)).collect() == []


def nearest(rows, k, every):
    """All scores, by brute force."""
    usable = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)): (i, v) for i, v in usable if i % every == 0}.values():
        scored = sorted((-int(sum(int(a) * int(b) for a, b in zip(x, y, strict=False))), i) for i, y in usable if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [4096, 37])
def test_top_k_is_exact(spark, monkeypatch, shard):
    monkeypatch.setattr(K, "SHARD", shard)
    monkeypatch.setattr(K, "QUERIES", 9 if shard < 100 else 512)
    monkeypatch.setattr(K, "IN_TURN", 2)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i % 5][1]) for i in range(60)]  # ties
    rows += [(400, None), (401, [1.0, None] * 8), (402, [float("nan")] * 16), (420, [float("inf")] * 16), (None, rows[0][1])]
    rows += [(440, [0.5, 0.5]), (441, []), (460, [0.0] * 16)]
    df = spark.createDataFrame([(i, v, 1.5, 2) for i, v in rows], "vec_id bigint, embedding array<float>, score double, rank int")
    out = K.search(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == nearest([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], 20, 20)
    assert K.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_large_values_stay_exact(spark):
    rows = [(0, [3e4, -2e4]), (1, [3e4 + 1 / 64, -2e4]), (2, [3e4, -2e4 - 1 / 64]), (3, [-3e4, 2e4])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = K.search(df, F.col("vec_id") == 0, k=2, scale=65536.0).collect()
    expected = sorted((-sum(int(np.floor(65536 * a)) * int(np.floor(65536 * b)) for a, b in zip(rows[0][1], v, strict=True)), i) for i, v in rows[1:])[:2]
    assert [(r["vec_id"], r["score"]) for r in sorted(out, key=lambda r: r["rank"])] == [(i, -s) for s, i in expected]
