"""Toxicity of whole texts: a bidirectional GRU with attention pooling over word and character inputs, in numpy."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kind, pick, ship

#: Words in a window, and from the start of one window to the next.
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
#: The directions, and where their states stand side by side.
SIDES = {"f": 0, "b": HIDDEN}
#: Buckets of character n-grams, and the lengths of n-grams in bytes of "<word>".
BUCKETS, GRAMS = 1 << 14, (3, 4, 5)
#: The bounded sample a model is fitted on: labelled texts of each label, and characters of all texts of one label,
#: behind which no further text is taken. Long and short texts enter alike, whole.
TOXIC_ROWS, CLEAN_ROWS, CHARACTERS = 800, 2400, 20_000_000
#: Words with a vector of their own: those in so many texts of the sample, at most so many of them.
LEAST_TEXTS, VOCABULARY = 3, 20_000
ROUNDS, STEPS_A_ROUND, BATCH, RATE = 4, 50, 256, 0.02
#: Word types that a worker keeps, words scored together, windows run together, and rows taken from an Arrow batch at once.
CACHED, SLICE, TOGETHER, ROWS = 100_000, 30_000, 1024, 32
_word = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _word.findall((text or "").lower())


def char_grams(types: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(type of each n-gram, its bucket) for the n-grams of "<type>", types in order."""
    encoded = [b"<" + t.encode() + b">" for t in types]
    data = np.frombuffer(b"".join(encoded) + b"\0" * max(GRAMS), np.uint8).astype(np.uint32)
    sizes = np.array([len(e) for e in encoded])
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(types)), sizes)
    place = np.arange(len(owner))
    owners, buckets = [], []
    for n in GRAMS:
        code = np.full(len(owner), n, np.uint32)
        for at in range(n):
            code = (code ^ data[at : at + len(owner)]) * np.uint32(16777619)
        code ^= code >> np.uint32(15)
        whole = place + n <= ends
        owners.append(owner[whole])
        buckets.append((code[whole] & np.uint32(BUCKETS - 1)).astype(np.int64))
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(owners)[order], np.concatenate(buckets)[order]


def window_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of all overlapping windows of texts that lie one behind the other; texts without words have none."""
    number = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = (np.cumsum(lengths) - lengths)[text] + nth * STRIDE
    return text, start, np.minimum(start + WINDOW, np.cumsum(lengths)[text])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Net:
    """Parameters; the gates are in the order update, reset, new."""

    vocabulary: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(vocabulary: dict[str, int], word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 5) -> Net:
        """Vectors start with smoothed log-odds in their first place and noise in the others."""
        rng = np.random.default_rng(seed)
        inputs, gates = WORD_DIM + CHAR_DIM, 3 * HIDDEN

        def noise(*shape, by=0.1):
            return rng.normal(0, by, shape).astype(np.float32)

        p = {"words": noise(len(vocabulary) + 1, WORD_DIM), "grams": noise(BUCKETS, CHAR_DIM)}
        p["words"][1:, 0], p["words"][0] = word_odds, 0
        p["grams"][:, 0] = gram_odds
        for side in SIDES:
            p |= {"x" + side: noise(inputs, gates, by=0.3), "u" + side: noise(HIDDEN, gates, by=0.3), "c" + side: np.zeros(gates, np.float32)}
        p |= {"a": noise(2 * HIDDEN, by=0.3), "w": noise(2 * HIDDEN, by=0.3), "o": np.zeros(1, np.float32)}
        return Net(vocabulary, p)

    def digest(self) -> str:
        return hashlib.sha256(b"".join(self.p[k].tobytes() for k in sorted(self.p))).hexdigest()

    def inputs(self, word_ids: np.ndarray, owner: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The input of each type: its word vector beside the mean of its n-gram vectors."""
        sizes = np.bincount(owner, minlength=len(word_ids))
        starts = np.cumsum(sizes) - sizes
        chars = np.add.reduceat(self.p["grams"][buckets], starts, axis=0) / sizes[:, None]
        return np.concatenate([self.p["words"][word_ids], chars.astype(np.float32)], axis=1)

    def gates(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What the inputs add to the gates of either direction."""
        return {side: inputs @ self.p["x" + side] + self.p["c" + side] for side in SIDES}

    def run(self, table: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows given as rows of the gate table; with keep also what the backward pass needs."""
        n, steps = ids.shape
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        kept = {}
        live = mask.astype(np.float32)
        padded = ~mask.all(axis=0)
        for side, offset in SIDES.items():
            u, h, gates = self.p["u" + side], np.zeros((n, HIDDEN), np.float32), table[side]
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x, g = gates.take(ids[:, t], axis=0), h @ u
                zr = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                before, h = h, new + z * (h - new)
                if padded[t]:
                    h *= live[:, t, None]
                states[t, :, offset : offset + HIDDEN] = h
                if keep:
                    kept[side, t] = z, r, new, g[:, 2 * HIDDEN :], before
        score = np.where(mask.T, states @ self.p["a"], -np.inf)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.p["w"] + self.p["o"][0]
        return (logits, states, weight, pooled, kept) if keep else logits

    def gradients(self, word_ids: np.ndarray, grams: tuple[np.ndarray, np.ndarray], ids: np.ndarray, mask: np.ndarray, target: np.ndarray):
        """Gradients of the mean logistic loss of windows; ids are rows of word_ids."""
        p, (n, steps) = self.p, ids.shape
        inputs = self.inputs(word_ids, *grams)
        table = self.gates(inputs)
        logits, states, weight, pooled, kept = self.run(table, ids, mask, keep=True)
        d_logit = ((sigmoid(logits) - target) / n).astype(np.float32)
        d = {"w": d_logit @ pooled, "o": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["w"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d["a"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * p["a"]
        d_inputs = np.zeros_like(inputs)
        by_type = np.argsort(ids.T, axis=None, kind="stable")
        types_at, first_at = np.unique(ids.T.reshape(-1)[by_type], return_index=True)
        live = mask.astype(np.float32)
        for side, offset in SIDES.items():
            d_gates = np.empty((steps, n, 3 * HIDDEN), np.float32)
            u, d_u, carry = p["u" + side], np.zeros_like(p["u" + side]), np.zeros((n, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if side == "f" else range(steps):
                z, r, new, g_new, before = kept[side, t]
                d_h = (d_states[t, :, offset : offset + HIDDEN] + carry) * live[:, t, None]
                d_new = d_h * (1 - z) * (1 - new * new)
                d_z, d_r = d_h * (before - new) * z * (1 - z), d_new * g_new * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_new * r], axis=1)
                carry = d_h * z + d_gate @ u.T
                d_u += before.T @ d_gate
                d_gate[:, 2 * HIDDEN :] = d_new
                d_gates[t] = d_gate
            part = np.zeros((len(word_ids), 3 * HIDDEN), np.float32)
            part[types_at] = np.add.reduceat(d_gates.reshape(-1, 3 * HIDDEN)[by_type], first_at, axis=0)
            d["u" + side], d["x" + side], d["c" + side] = d_u, inputs.T @ part, part.sum(axis=0)
            d_inputs += part @ p["x" + side].T
        d["words"], d["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(d["words"], word_ids, d_inputs[:, :WORD_DIM])
        d["words"][0] = 0
        owner, buckets = grams
        sizes = np.bincount(owner, minlength=len(word_ids))
        order = np.argsort(buckets, kind="stable")
        used, first_at = np.unique(buckets[order], return_index=True)
        d["grams"][used] = np.add.reduceat((d_inputs[:, WORD_DIM:] / sizes[:, None])[owner[order]], first_at, axis=0)
        return d


class Types:
    """Word types with their rows in the gate table, up to a bound; then it starts anew."""

    def __init__(self, net: Net, limit: int):
        self.net, self.limit, self.row = net, limit, {}
        self.table = {side: np.zeros((0, 3 * HIDDEN), np.float32) for side in SIDES}

    def rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.row]
        if len(self.row) + len(new) > self.limit:
            self.row, new = {}, list(set(words))
        if new:
            first = len(self.row)
            ids = np.array([self.net.vocabulary.get(w, 0) for w in new])
            made = self.net.gates(self.net.inputs(ids, *char_grams(new)))
            for side, rows in made.items():
                if len(self.table[side]) < first + len(new):
                    grown = np.zeros((max(2 * len(self.table[side]), first + len(new)), 3 * HIDDEN), np.float32)
                    grown[:first] = self.table[side][:first]
                    self.table[side] = grown
                self.table[side][first : first + len(new)] = rows
            self.row.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))


def _windows_at(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = start[:, None] + np.arange(WINDOW)
    mask = at < end[:, None]
    return rows[np.minimum(at, end[:, None] - 1)], mask


def window_logits(net: Net, table: dict[str, np.ndarray], rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.float32)
    for at in range(0, len(start), TOGETHER):
        part = slice(at, at + TOGETHER)
        ids, mask = _windows_at(rows, start[part], end[part])
        longest = int((end[part] - start[part]).max())
        out[part] = net.run(table, ids[:, :longest], mask[:, :longest])
    return out


def score_texts(net: Net | None, types: Types | None, texts: Sequence[str | None]) -> np.ndarray:
    """A score from 0 to 1 for each whole text: that of its most toxic window; 0 without words or without a model."""
    out = np.zeros(len(texts))
    if net is None:
        return out
    held: list[str] = []
    lengths: list[int] = []
    first = 0

    def flush(upto: int) -> None:
        text, start, end = window_table(np.array(lengths))
        if len(text):
            logits = window_logits(net, types.table, rows, start, end)
            some, at = np.unique(text, return_index=True)
            out[first + some] = sigmoid(np.maximum.reduceat(logits, at).astype(np.float64))

    for n, text in enumerate(texts):
        words = words_of(text)
        held += words
        lengths.append(len(words))
        if len(held) >= SLICE or n == len(texts) - 1:
            rows = types.rows(held)
            flush(n + 1)
            held, lengths, first = [], [], n + 1
    return out


def _odds(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of occurring in a toxic text against a clean one, within -4 and 4."""
    rate = (hits + 0.5) / (totals + 1)
    return np.clip(np.log(rate[1] / rate[0]), -4, 4).astype(np.float32)


def train(texts: list[str], toxic: np.ndarray, seed: int = 5) -> Net | None:
    """Fit a net on labelled texts; None unless both labels occur among texts with words.

    A text is toxic if one of its windows is. In every round the net first picks the window that looks
    most toxic of each text, two of clean ones, and then learns from the picked windows.
    """
    row: dict[str, int] = {}
    tokens = [np.fromiter((row.setdefault(w, len(row)) for w in words_of(t)), np.int32) for t in texts]
    kept = [i for i, x in enumerate(tokens) if len(x)]
    tokens, toxic = [tokens[i] for i in kept], np.asarray(toxic, np.float32)[kept]
    if not (toxic > 0).any() or not (toxic == 0).any():
        return None
    rng = np.random.default_rng(seed)
    types, distinct = list(row), [np.unique(x) for x in tokens]
    seen = np.bincount(np.concatenate(distinct), minlength=len(types))
    common = np.array(sorted(np.flatnonzero(seen >= LEAST_TEXTS).tolist(), key=lambda i: (-seen[i], types[i]))[:VOCABULARY], np.int64)
    vocabulary = {types[i]: n + 1 for n, i in enumerate(common.tolist())}
    sizes, buckets = [], []
    for at in range(0, len(types), SLICE):
        some = types[at : at + SLICE]
        owner, found = char_grams(some)
        sizes.append(np.bincount(owner, minlength=len(some)))
        buckets.append(found.astype(np.uint16))  # BUCKETS fit; the n-grams of all types are the largest array here
    sizes, buckets = np.concatenate(sizes), np.concatenate(buckets)
    starts_of = np.cumsum(sizes) - sizes

    def grams_of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `some`, bucket) of the n-grams of some types."""
        own = np.repeat(np.arange(len(some)), sizes[some])
        first = np.cumsum(sizes[some]) - sizes[some]
        return own, buckets[starts_of[some][own] + np.arange(len(own)) - first[own]]

    def gate_table(net: Net) -> dict[str, np.ndarray]:
        parts = [net.gates(net.inputs(word_ids[some], *grams_of(some))) for some in np.array_split(np.arange(len(types)), 1 + len(types) // 20_000)]
        return {side: np.concatenate([x[side] for x in parts]) for side in SIDES}

    word_hits, gram_hits = np.zeros((2, len(types))), np.zeros((2, BUCKETS))
    for own, label in zip(distinct, toxic.astype(int), strict=True):
        word_hits[label, own] += 1
        gram_hits[label, np.unique(grams_of(own)[1])] += 1
    totals = np.array([[(toxic == 0).sum()], [(toxic > 0).sum()]], float)
    word_odds = _odds(word_hits, totals)[common]
    net = Net.fresh(vocabulary, word_odds, _odds(gram_hits, totals), seed)

    word_ids = np.array([vocabulary.get(w, 0) for w in types])
    rows = np.concatenate(tokens).astype(np.int64)
    text, start, end = window_table(np.array([len(x) for x in tokens]))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    odds = np.zeros(len(types), np.float32)
    odds[common] = word_odds
    for turn in range(ROUNDS):
        if turn:
            looks = window_logits(net, gate_table(net), rows, start, end)
        else:
            sums = np.concatenate([[0], np.cumsum(np.maximum(odds[rows], 0))])
            looks = sums[end] - sums[start]
        order = np.lexsort((-looks, text))
        nth = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        picked = order[(nth == 0) | ((nth == 1) & (toxic[text[order]] == 0))]
        for _ in range(STEPS_A_ROUND):
            some = rng.choice(picked, min(BATCH, len(picked)), replace=False)
            ids, mask = _windows_at(rows, start[some], end[some])
            used, local = np.unique(ids, return_inverse=True)
            found = net.gradients(word_ids[used], grams_of(used), local.reshape(ids.shape), mask, toxic[text[some]])
            step += 1
            for k, g in found.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    looks = window_logits(net, gate_table(net), rows, start, end)
    net.p["o"] -= np.float32(_cut(np.maximum.reduceat(looks, np.flatnonzero(np.diff(text, prepend=-1))), toxic > 0))
    return net


def _cut(looks: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that parts the sample's texts with the fewest errors; within a gap nearer to the toxic side.

    Long texts have more windows, so the clean end of the gap is the one that other texts reach beyond.
    """
    order = np.argsort(looks, kind="stable")
    missed = np.concatenate([[0], np.cumsum(toxic[order])])
    errors = missed + np.concatenate([np.cumsum(~toxic[order][::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    edge = np.concatenate([[looks.min()], np.sort(looks), [looks.max()]])
    return float(0.3 * edge[best[0]] + 0.7 * edge[best[-1] + 1])


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves no remainder by 5; rows with a null id are held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, toxic_rows: int, clean_rows: int, longest: int | None = None
) -> DataFrame:
    """(place, id, text, toxic) of the sample: per label the texts whose ids hash lowest, in the order of place.

    Only as many are taken as hold CHARACTERS characters, the last one whole. Rows whose id is held
    out, null labels and texts without a label never enter. An id that is labelled both ways counts as
    toxic; equal texts of an id are one. With `longest`, longer texts are left out.
    """
    marked = pick(labels, id=id_col, toxic=label_col).filter(F.col("toxic").isNotNull() & ~held_out("id"))
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = pick(df, id=id_col, text=text_col).filter(F.col("text").isNotNull()).withColumn("hash", F.xxhash64("text"))
    sizes = texts.select("id", "hash", F.length("text").alias("chars"))
    sizes = sizes if longest is None else sizes.filter(F.col("chars") <= longest)
    met = sizes.join(marked, "id").groupBy("id", "hash").agg(F.max("toxic").alias("toxic"), F.max("chars").alias("chars"))
    chosen = []
    for condition, n in (("toxic > 0", toxic_rows), ("toxic <= 0", clean_rows)):
        held = 0
        for row in met.filter(condition).orderBy(F.xxhash64("id"), "id", "hash").limit(n).collect():
            if held >= CHARACTERS:
                break
            chosen.append((len(chosen), row["id"], row["hash"], row["toxic"]))
            held += row["chars"]
    rows = df.sparkSession.createDataFrame(chosen, f"place int, id {kind(met, 'id')}, hash bigint, toxic {kind(met, 'toxic')}")
    return texts.join(F.broadcast(rows), ["id", "hash"]).dropDuplicates(["place"]).select("place", "id", "text", "toxic")


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    longest: int | None = None,
) -> Net | None:
    """Train on the driver over the bounded sample of training_rows()."""
    rows = training_rows(df, labels, id_col, text_col, label_col, toxic_rows, clean_rows, longest).collect()
    rows.sort(key=lambda r: r["place"])
    return train([r["text"] for r in rows], np.array([float(r["toxic"] > 0) for r in rows]))


#: What a worker knows of the words of the model it used last.
_types: dict[str | None, Types | None] = {}


def score_column(spark: SparkSession, net: Net | None, text_col: str = "text") -> Column:
    """The score of a text column; only that column goes to Python, in Arrow batches."""
    ship(spark)
    model = spark.sparkContext.broadcast(net)  # parameters only: their number is fixed
    key = None if net is None else net.digest()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if key not in _types:
            _types.clear()
            _types[key] = Types(model.value, CACHED) if key else None
        parts = [score_texts(model.value, _types[key], texts.slice(at, ROWS).to_pylist()) for at in range(0, len(texts), ROWS)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return score(F.col(f"`{text_col}`").cast("string"))


def score_documents(df: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted (1 if score >= 0.5).

    Every whole text is read in overlapping windows, and its score is that of the window which looks
    most toxic. A null or empty text, or one without words, scores 0, as does everything without a
    model (no labels of one kind). Only the text enters a score; equal texts score alike. Other
    columns are not looked at, null or repeated ids pass through.
    """
    rows = pick(df, id=id_col, text=text_col)
    scored = rows.select("id", score_column(df.sparkSession, net).alias("score"))
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(df: DataFrame, net: Net | None, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of df, with all their columns, whose text scores below `most`."""
    return df.filter(score_column(df.sparkSession, net, text_col) < most)
