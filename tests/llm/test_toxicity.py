"""The network against finite differences and held-out texts, windows, and edge cases of scoring."""

import random
import zlib

import numpy as np

from wardlight.llm import toxicity as X

RUDE = ["idiot", "moron", "scumbag"]


def labelled(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        text = [rnd.choice(["the", "cat", "sat", "on", "a", "mat", f"w{rnd.randrange(400)}"]) for _ in range(rnd.randrange(5, 120))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2):
                text[rnd.randrange(len(text))] = rnd.choice(RUDE) if rnd.random() < 0.7 else "zzgrumpf" + "abcdefgh"[rnd.randrange(8) :]
        out.append((i, " ".join(text), toxic))
    return out


def test_gradients():
    rng = np.random.default_rng(1)
    net = X.Net.fresh({"a": 1, "bc": 2}, np.zeros(2), np.zeros(X.BUCKETS))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    types = ["a", "bc", "def"]
    word_ids, grams = np.array([1, 2, 0]), X.char_grams(types)
    ids = rng.integers(0, 3, (4, 6))
    mask = np.arange(6) < np.array([6, 3, 1, 5])[:, None]
    target = np.array([1.0, 0, 1, 0])

    def loss():
        logits = net.run(net.gates(net.inputs(word_ids, *grams)), ids, mask).astype(np.float64)
        return float(np.mean(np.logaddexp(0, logits) - target * logits))

    d = net.gradients(word_ids, grams, ids, mask, target)
    for name, value in net.p.items():
        flat, step = value.reshape(-1), 1e-2
        places = np.flatnonzero(d[name].reshape(-1))[:4]
        for at in places:
            old = flat[at]
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * step) - d[name].reshape(-1)[at]) < 2e-3, name


def test_windows_cover_every_word():
    lengths = np.array([0, 1, X.WINDOW, X.WINDOW + 1, 5 * X.WINDOW + 3, 0])
    text, start, end = X.window_table(lengths)
    first = np.cumsum(lengths) - lengths
    for t, n in enumerate(lengths):
        seen = {i for s, e in zip(start[text == t], end[text == t], strict=True) for i in range(s, e)}
        assert seen == set(range(first[t], first[t] + n))
    assert (end - start <= X.WINDOW).all()


def test_grams_are_marked_at_both_ends():
    owner, buckets = X.char_grams(["ab", "ß"])
    assert np.bincount(owner).tolist() == [2 + 1, 2 + 1]  # <ab> has 4 bytes, so has <ß>
    assert not set(X.char_grams(["cat"])[1]) & set(X.char_grams(["dog"])[1])


def test_held_out_texts_and_edge_rows(spark):
    rows = labelled(420, 1)
    docs = [(i, t, "en", 0.5) for i, t, _ in rows] + [(1000, "", "en", 0.1), (1001, None, "en", 0.1), (1002, "123 !!", "en", 0.1)]
    docs += [(None, rows[0][1], "de", 0.1), (0, rows[0][1], "en", 0.9), (1003, "clean words here " * 20000 + "you idiot moron", "en", 0.9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, score double")
    marks = [(i, int(y), 0) for i, _, y in rows if i % 7] + [(None, 1, 0), (5000, 1, 1), (3, None, 1), (2, 0, 0), (2, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, text int")
    used = X.training_rows(df, labels, "doc_id", "text", "toxic", 50, 100, 8000).collect()
    assert sum(r["toxic"] for r in used) == 50 and len(used) <= 150
    assert all(zlib.crc32(str(r["id"]).encode()) % 5 and r["id"] % 7 for r in used)
    net = X.fit(df, labels)
    out = X.score_documents(df, net).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    found = {r["doc_id"]: r for r in out}
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert [found[i]["score"] for i in (1000, 1001, 1002)] == [0, 0, 0]
    assert found[1003]["predicted"] == 1 and found[None]["score"] == found[0]["score"]
    held = [(found[i]["predicted"], int(y)) for i, _, y in rows if found[i]["held_out"]]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert {r["doc_id"] for r in X.drop_toxic(df, net).collect()} == {r["doc_id"] for r in out if not r["predicted"]}
    assert X.score_documents(df.limit(0), net).collect() == []
    nothing = X.fit(df, labels.limit(0))
    assert nothing is None and {r["score"] for r in X.score_documents(df, nothing).collect()} == {0.0}


def test_long_texts_and_all_labelled_documents_enter_the_sample(spark, monkeypatch):
    docs = [(i, ("clean words here " if i % 2 else "you idiot moron ") * (700 if i < 40 else 2)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(2000)], "doc_id bigint, toxic int")
    usual = (df, labels, "doc_id", "text", "toxic")
    used = X.training_rows(*usual, 100, 100).collect()
    assert {r["id"]: r["text"] for r in used} == {i: t for i, t in docs if zlib.crc32(str(i).encode()) % 5}
    assert len(X.training_rows(*usual, 7, 9).collect()) == 16  # labels without a document take no one's place
    monkeypatch.setattr(X, "CHARACTERS", 1)
    assert len(X.training_rows(*usual, 7, 9).collect()) == 2
    assert X.fit(df.limit(40), labels) is not None


def test_slices_do_not_change_scores(monkeypatch):
    rows = labelled(120, 2)
    net = X.train([t for _, t, _ in rows], np.array([y for *_, y in rows]))
    texts = [t for _, t, _ in rows] + ["", None]
    whole = X.score_texts(net, X.Types(net, 10**6), texts)
    monkeypatch.setattr(X, "SLICE", 100)
    assert np.allclose(whole, X.score_texts(net, X.Types(net, 150), texts), atol=1e-5)
