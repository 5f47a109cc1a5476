"""Phrase collocations from weighted acyclic automata of n-grams.

Tasks turn texts into shards of bounded size. From the sorted n-grams of a shard grows a count transducer:
an acyclic automaton whose states are phrases, whose arcs are words, and whose weights count the paths that end
there. Transducers are cut by ranges of their prefixes; in each range they are united and their weights
summed. The parts of a phrase are looked up by composing an automaton of all wanted parts with the counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.indexing import add_dense_index
from ..operators.skew import lookup_join, salted_join
from ..session import write_stage
from .common import pick, ship, strings

#: Longest phrase in words, least count of a candidate, phrases reported for each language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A longer phrase with this share of the count, in percent, replaces its parts. Scores are whole parts of SCALE.
COVERS, SCALE = 80, 2_000_000
#: Words in a shard, arcs in a prefix range, bytes of a text that are split into words together.
SHARD_WORDS, RANGE_ARCS, SLICE = 1 << 20, 2_000_000, 1 << 20
NO_LANG = "und"
BREAK = 0
WORD_BITS = 32
WORD = (1 << WORD_BITS) - 1
IDS = [f"w{i}" for i in range(1, LONGEST + 1)]

# The marks that end a piece, and the tab, which parts words as the blank does.
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


# --- shards ---------------------------------------------------------------------------------------------------------


class Numbers(dict):
    """Consecutive numbers from 1 for the words that are asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


class Shard:
    """Words of texts of one language as numbers, with a BREAK between pieces.

    The first `context` words end the piece that the shard before was cut in: only n-grams that end behind
    them count here.
    """

    def __init__(self, context: list[bytes] = ()):
        self.numbers = Numbers()
        self.seq = [self.numbers[w] for w in context]
        self.context = len(context)

    def add(self, words: list[bytes]) -> None:
        self.seq.extend(map(self.numbers.__getitem__, words))

    def end_piece(self) -> None:
        if self.seq and self.seq[-1] != BREAK:
            self.seq.append(BREAK)

    def following(self) -> Shard:
        """The next shard of the language, which takes up an open piece."""
        tail = self.seq[-(LONGEST - 1) :]
        tail = tail[len(tail) - tail[::-1].index(BREAK) :] if BREAK in tail else tail
        words = list(self.numbers)
        return Shard([words[i - 1] for i in tail])

    def counts(self) -> np.ndarray:
        return np.bincount(np.array(self.seq[self.context :], np.int64), minlength=len(self.numbers) + 1)[1:]


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of about `size` bytes that end between words."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            ends = [x for x in (text.find(b" ", end), text.find(b"\n", end)) if x >= 0]
            end = min(ends) if ends else len(text)
        yield text[start:end]
        start = end


def read_shards(rows: Iterator[tuple[str, bytes]], shard_words: int, size: int) -> Iterator[tuple[str, Shard]]:
    """Shards of all languages together hold about shard_words words at a time."""
    shards: dict[str, Shard] = {}
    held = 0
    for lang, text in rows:
        if lang not in shards:
            shards[lang] = Shard()
        for part in slices(text.lower().translate(_PIECES), size):
            shard = shards[lang]
            for at, piece in enumerate(part.split(b"\n")):
                if at:
                    shard.end_piece()
                words = piece.split()
                for start in range(0, len(words), shard_words):
                    some = words[start : start + shard_words]
                    shard.add(some)
                    held += len(some)
                    if held >= shard_words:
                        yield from shards.items()
                        shards, held = {lang: shard.following()}, 0
                        shard = shards[lang]
        shards[lang].end_piece()
    yield from shards.items()


def _shards(df: DataFrame) -> DataFrame:
    """(shard, lang, words, counts, seq, context): names of shards are random, so the table is written once and kept."""
    shard_words, size = SHARD_WORDS, SLICE
    fields = [("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("seq", pa.binary()), ("context", pa.int32())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (pair for b in batches for pair in zip(strings(b.column("lang")), strings(b.column("text")), strict=True))
        for lang, shard in read_shards(rows, shard_words, size):
            if len(shard.seq) > shard.context:
                seq = np.array(shard.seq, "<u4").tobytes()
                row = [uuid.uuid4().int >> 65], [lang], [list(shard.numbers)], [shard.counts()], [seq], [shard.context]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    kinds = "shard bigint, lang string, words array<binary>, counts array<bigint>, seq binary, context int"
    return df.mapInArrow(run, kinds)


# --- transducers ----------------------------------------------------------------------------------------------------


@dataclass
class Transducer:
    """Counts of word sequences. An arc of level i leads from a state of level i - 1 over a word to a state of its own.

    key: state << 32 | word, ascending, so that a state's arcs lie together; weight: the count of the
    sequence that ends there.
    """

    key: list[np.ndarray]
    weight: list[np.ndarray]

    @classmethod
    def build(cls, paths: np.ndarray, weights: np.ndarray) -> Transducer:
        """From sequences (rows, LONGEST), filled up with 0: each word opens the states that its prefix lacks."""
        state, rows = np.zeros(len(paths), np.int64), np.arange(len(paths))
        keys, sums = [], []
        for level in range(LONGEST):
            rows = rows[paths[rows, level] > 0]
            arcs, state[rows] = np.unique(state[rows] << WORD_BITS | paths[rows, level], return_inverse=True)
            ends = rows if level == LONGEST - 1 else rows[paths[rows, level + 1] == 0]
            total = np.zeros(len(arcs), np.int64)
            np.add.at(total, state[ends], weights[ends])
            keys.append(arcs)
            sums.append(total)
        return cls(keys, sums)

    @classmethod
    def from_words(cls, seq: np.ndarray, context: int) -> Transducer:
        """All sequences of 2 to LONGEST words within pieces that end behind the context; BREAK parts pieces."""
        state = np.unique(seq[seq > 0])
        keys, sums = [state], [np.zeros(len(state), np.int64)]
        start = np.flatnonzero(seq > 0)
        at = np.searchsorted(state, seq[start])
        for length in range(2, LONGEST + 1):
            inside = start + length - 1 < len(seq)
            start, at = start[inside], at[inside]
            goes_on = seq[start + length - 1] > 0
            start, at = start[goes_on], at[goes_on]
            arcs, at = np.unique(at << WORD_BITS | seq[start + length - 1], return_inverse=True)
            keys.append(arcs)
            sums.append(np.bincount(at[start + length - 1 >= context], minlength=len(arcs)))
        return cls(keys, sums)

    @classmethod
    def union(cls, parts: list[Transducer]) -> Transducer:
        """One transducer that accepts what any part does, with the sum of their weights."""
        keys, sums = [], []
        states = [np.zeros(1, np.int64) for _ in parts]
        for level in range(LONGEST):
            moved = [s[p.key[level] >> WORD_BITS] << WORD_BITS | p.key[level] & WORD for s, p in zip(states, parts, strict=True)]
            arcs, at = np.unique(np.concatenate(moved), return_inverse=True)
            total = np.zeros(len(arcs), np.int64)
            np.add.at(total, at, np.concatenate([p.weight[level] for p in parts]))
            keys.append(arcs)
            sums.append(total)
            states = np.split(at, np.cumsum([len(m) for m in moved])[:-1])
        return cls(keys, sums)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(sequences, weights) of all states with a weight, filled up with 0."""
        found, weights, here = [], [], np.zeros((1, 0), np.int64)
        for level in range(LONGEST):
            here = np.column_stack([here[self.key[level] >> WORD_BITS], self.key[level] & WORD])
            counted = self.weight[level] > 0
            found.append(np.pad(here[counted], ((0, 0), (0, LONGEST - 1 - level))))
            weights.append(self.weight[level][counted])
        return np.concatenate(found), np.concatenate(weights)

    def at_least(self, weight: int) -> Transducer:
        """Only the sequences with at least this weight, and the states on the way to them."""
        paths, weights = self.paths()
        return Transducer.build(paths[weights >= weight], weights[weights >= weight])

    def compose(self, counts: Transducer) -> list[np.ndarray]:
        """For each level the weights that `counts` gives to the states of this automaton, 0 where it has no such path."""
        out, state = [], np.zeros(1, np.int64)
        for level in range(LONGEST):
            above = state[self.key[level] >> WORD_BITS]
            wanted = above << WORD_BITS | self.key[level] & WORD
            place = np.minimum(np.searchsorted(counts.key[level], wanted), max(0, len(counts.key[level]) - 1))
            met = (above >= 0) & (counts.key[level][place] == wanted) if len(counts.key[level]) else np.zeros(len(wanted), bool)
            state = np.where(met, place, -1)
            out.append(np.where(met, counts.weight[level][place], 0) if len(counts.key[level]) else np.zeros(len(wanted), np.int64))
        return out

    def dump(self) -> tuple[list[int], bytes, str, bytes, str, bytes]:
        """Sizes of the levels, words, and in narrow types the arcs of each state and the weights."""
        above = [1, *(len(k) for k in self.key[:-1])]
        words = np.concatenate(self.key) & WORD
        arcs = [np.bincount(k >> WORD_BITS, minlength=n) for k, n in zip(self.key, above, strict=True)]
        return [len(k) for k in self.key], words.astype("<u4").tobytes(), *_narrow(np.concatenate(arcs)), *_narrow(np.concatenate(self.weight))

    @classmethod
    def load(cls, sizes, words: bytes, arcs_kind: str, arcs: bytes, weights_kind: str, weights: bytes) -> Transducer:
        cuts, above = np.cumsum(sizes)[:-1], np.array([1, *sizes[:-1]])
        words = np.split(np.frombuffer(words, "<u4").astype(np.int64), cuts)
        arcs = np.split(np.frombuffer(arcs, arcs_kind).astype(np.int64), np.cumsum(above)[:-1])
        keys = [np.repeat(np.arange(len(a)), a) << WORD_BITS | w for a, w in zip(arcs, words, strict=True)]
        return cls(keys, np.split(np.frombuffer(weights, weights_kind).astype(np.int64), cuts))


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    """The smallest type that holds whole numbers from 0 on, and the numbers in it."""
    kind = np.min_scalar_type(int(values.max(initial=0))).str
    return kind, values.astype(kind).tobytes()


_COLUMNS = ["sizes", "words", "arcs_kind", "arcs", "weights_kind", "weights"]
STORED = "sizes array<int>, words binary, arcs_kind string, arcs binary, weights_kind string, weights binary"


def range_of(paths: np.ndarray, spread: np.ndarray, n_ranges: int, n_words: int) -> np.ndarray:
    """The prefix range of each sequence: that of its first word. A word with too many arcs takes `spread` ranges,
    told apart by the second and third word."""
    base = (paths[:, 0] - 1) * n_ranges // n_words
    second, third = paths[:, 1].astype(np.uint64), paths[:, 2].astype(np.uint64)
    mixed = (second * np.uint64(0x9E3779B97F4A7C15) + third * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(WORD_BITS)
    return (base + mixed.astype(np.int64) % spread) % n_ranges


def cut_shard(seq: np.ndarray, context: int, ids: np.ndarray, spread: np.ndarray, n_ranges: int, n_words: int) -> list[tuple]:
    """(range, transducer) of a shard of word ids; ids and spread tell into how many ranges a word goes."""
    paths, weights = Transducer.from_words(seq, context).paths()
    order = np.argsort(ids)
    first = order[np.searchsorted(ids, paths[:, 0], sorter=order)] if len(paths) else np.zeros(0, int)
    ranges = range_of(paths, spread[first], n_ranges, n_words)
    order = np.argsort(ranges, kind="stable")
    numbers, starts = np.unique(ranges[order], return_index=True)
    return [(int(n), Transducer.build(paths[at], weights[at])) for n, at in zip(numbers, np.split(order, starts[1:]), strict=False)]


def _stored(parts: list[tuple]) -> pd.DataFrame:
    rows = [(n, *made.dump()) for n, made in parts]
    return pd.DataFrame(rows, columns=["range", *_COLUMNS])


def _loaded(rows: pd.DataFrame) -> list[Transducer]:
    return [Transducer.load(*row) for row in rows[_COLUMNS].itertuples(index=False)]


# --- counts and parts -----------------------------------------------------------------------------------------------


@dataclass
class Layout:
    """How the transducers are cut into prefix ranges."""

    n_ranges: int
    n_words: int


def _vocabulary(shards: DataFrame, least: int) -> tuple[DataFrame, Layout]:
    """(lang, word, f, id, spread) of the words with a count of at least `least`, numbered from 1 in the order of a hash.

    No phrase with rarer words can be a candidate, or a part of one.
    """
    each = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    counted = each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    frequent = counted.filter(F.col("f") >= least).withColumn("place", F.xxhash64("lang", "word"))
    frequent = write_stage(frequent, "words")
    n_words, total = frequent.agg(F.count(F.lit(1)), F.sum("f")).first()
    arcs = (LONGEST - 1) * (total or 0)
    cores = shards.sparkSession.sparkContext.defaultParallelism
    layout = Layout(max(1, -(-arcs // RANGE_ARCS), min(2 * cores, arcs // 100_000)), max(1, n_words))
    numbered = add_dense_index(frequent, "place", "id", ("lang", "word"))
    spread = F.least(F.lit(layout.n_ranges), F.ceil(F.col("f") * (LONGEST - 1) / RANGE_ARCS)).cast("bigint")
    return write_stage(numbered.select("lang", "word", "f", (F.col("id") + 1).alias("id"), spread.alias("spread")), "numbered"), layout


def _automata(shards: DataFrame, vocabulary: DataFrame, layout: Layout, least: int) -> DataFrame:
    """(range and a stored transducer): one for each prefix range, of all sequences with at least `least` counts."""
    words = shards.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    named = lookup_join(words, vocabulary, ["lang", "word"], "inner").select("shard", (F.col("place") + 1).alias("place"), "id", "spread")
    n_ranges, n_words = layout.n_ranges, layout.n_words

    def cut(shard: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or words.empty:
            return _stored([])
        local = np.frombuffer(shard["seq"].iloc[0], "<u4")
        ids = np.zeros(int(local.max()) + 1, np.int64)
        ids[words["place"]] = words["id"]
        made = cut_shard(ids[local], int(shard["context"].iloc[0]), words["id"].to_numpy(), words["spread"].to_numpy(), n_ranges, n_words)
        return _stored(made)

    def unite(parts: pd.DataFrame) -> pd.DataFrame:
        return _stored([(int(parts["range"].iloc[0]), Transducer.union(_loaded(parts)).at_least(least))])

    texts = shards.select(F.col("shard").alias("name"), "seq", "context").groupBy("name")
    parts = texts.cogroup(named.groupBy("shard")).applyInPandas(cut, f"range bigint, {STORED}")
    return write_stage(parts.groupBy("range").applyInPandas(unite, f"range bigint, {STORED}"), "automata")


def _sequences(automata: DataFrame) -> DataFrame:
    """(w1, .., a): all counted sequences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for made in _loaded(batch):
                paths, weights = made.paths()
                yield pd.DataFrame({**{c: paths[:, i] for i, c in enumerate(IDS)}, "a": weights})

    return automata.mapInPandas(run, ", ".join(f"{c} bigint" for c in IDS) + ", a bigint")


def _look_up(wanted: DataFrame, automata: DataFrame, layout: Layout) -> DataFrame:
    """Add f, its count, to every row of `wanted` (w1, .., spread, longer), whose sequences differ.

    The wanted sequences of a prefix range make up an automaton that is composed with the counts of the range.
    """
    n_ranges, n_words = layout.n_ranges, layout.n_words
    ids = ", ".join(f"{c} bigint" for c in IDS)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(range=range_of(b[IDS].to_numpy(np.int64), b["spread"].to_numpy(np.int64), n_ranges, n_words))

    def find(wanted: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        asked = Transducer.build(wanted[IDS].to_numpy(np.int64), wanted["longer"].to_numpy(np.int64))
        paths, longer = asked.paths()
        counted = asked.compose(Transducer.union(_loaded(counts))) if len(counts) else [np.zeros_like(w) for w in asked.weight]
        f = np.concatenate([c[w > 0] for c, w in zip(counted, asked.weight, strict=True)])
        return pd.DataFrame({**{c: paths[:, i] for i, c in enumerate(IDS)}, "longer": longer, "f": f})

    placed = wanted.mapInPandas(place, f"{ids}, spread bigint, longer bigint, range bigint")
    met = placed.groupBy("range").cogroup(automata.groupBy("range"))
    return met.applyInPandas(find, f"{ids}, longer bigint, f bigint")


def _with_words(sequences: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add lang and, in order, the array `words` of (place, word, f, id, spread) to sequences."""
    places = F.posexplode(F.filter(F.array(*IDS), lambda x: x > 0)).alias("place", "id")
    # One word can be in very many sequences.
    each = salted_join(sequences.select(*IDS, "a", places), vocabulary, ["id"], "inner")
    word = F.struct("place", F.col("word").cast("string").alias("word"), "f", "id", "spread")
    return each.groupBy(*IDS).agg(F.max("a").alias("a"), F.max("lang").alias("lang"), F.sort_array(F.collect_list(word)).alias("words"))


def _parts(candidates: DataFrame) -> DataFrame:
    """One row for every part of two words or more: the candidate's ids and count, the part's ids p1, .., its spread,
    where it starts, its length and the candidate's length."""
    spans = [(start, size) for size in range(2, LONGEST) for start in range(LONGEST - size + 1)]
    n = F.size("words")

    def span(start: int, size: int) -> Column:
        ids = [(F.get("words", F.lit(start + i))["id"] if i < size else F.lit(0).cast("bigint")).alias(f"p{i + 1}") for i in range(LONGEST)]
        made = F.struct(*ids, F.get("words", F.lit(start))["spread"].alias("spread"), F.lit(start).alias("start"), F.lit(size).alias("size"))
        return F.when((n > size) & (n >= start + size), made)

    each = candidates.select(*IDS, "a", n.alias("n_words"), F.explode(F.array_compact(F.array(*[span(*s) for s in spans]))).alias("part"))
    return each.select(*IDS, "a", "n_words", "part.*")


def collocations(
    df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP, covers: int = COVERS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of 2 to LONGEST words that hold together best, for each lang.

    A-Z count as lower case; phrases lie between marks and line breaks. A phrase is a candidate from `least`
    occurrences (a) on. Of its cuts into a first part (l occurrences) and a rest (r) the one with the lowest
    floor(SCALE * a / (l + r)) is its score, ties going to the shortest first part. Candidates within a longer one
    that has at least `covers` percent of their count are left out. n counts the words of the language. Ties of
    score and count go to the smaller phrase in bytes.

    A null lang counts as NO_LANG, a null text as empty; repeated rows count each time; other columns play no
    part, whatever their names. Without candidates, or on an empty table, there are no rows. All texts are
    counted whole: shards cut long ones between words and take up the open phrase in the next.
    """
    ship(df.sparkSession)
    rows = pick(df, lang=lang_col, text=text_col)
    rows = rows.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    shards = write_stage(_shards(rows), "shards")
    sizes = shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda t, x: t + x)).alias("n"))
    vocabulary, layout = _vocabulary(shards, least)
    automata = _automata(shards, vocabulary, layout, least)
    candidates = write_stage(_with_words(_sequences(automata), vocabulary), "candidates")
    parts = _parts(candidates)

    as_part = [F.col(f"p{i + 1}").alias(c) for i, c in enumerate(IDS)]
    wanted = parts.groupBy(*as_part, "spread").agg(F.max("a").alias("longer"))
    found = write_stage(_look_up(wanted, automata, layout), "parts")

    # Counts of both sides of each cut, all for the candidate they belong to.
    cuts = range(1, LONGEST)
    words, n = F.col("words"), F.size("words")
    ends = candidates.select(
        *IDS, "lang", "a", F.array_join(F.transform(words, lambda w: w["word"]), " ").alias("phrase"), F.get(words, F.lit(0))["f"].alias("l1"),
        *[F.when(n == k + 1, F.get(words, F.lit(k))["f"]).alias(f"r{k}") for k in cuts],
    )
    sides = parts.filter("start = 0 or start + size = n_words").select(*IDS, *[f"p{i + 1}" for i in range(LONGEST)], "start", "size")
    counted = found.select(*[F.col(c).alias(f"p{i + 1}") for i, c in enumerate(IDS)], "f")
    sides = salted_join(sides, counted, [f"p{i + 1}" for i in range(LONGEST)], "inner")
    sides = sides.select(
        *IDS,
        *[F.when((F.col("start") == 0) & (F.col("size") == k), F.col("f")).alias(f"l{k}") for k in cuts],
        *[F.when(F.col("start") == k, F.col("f")).alias(f"r{k}") for k in cuts],
    )
    facts = ends.unionByName(sides, allowMissingColumns=True).unionByName(found.select(*IDS, "longer"), allowMissingColumns=True)
    names = ["lang", "phrase", "a", "longer", *[f"{side}{k}" for k in cuts for side in "lr"]]
    whole = facts.groupBy(*IDS).agg(*[F.max(c).alias(c) for c in names])

    def cut(k: int) -> Column:
        score = F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div (cast(l{k} as decimal(20, 0)) + r{k})")
        return F.when(F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    alone = F.coalesce(F.expr(f"100 * cast(longer as decimal(20, 0)) < {covers} * cast(a as decimal(20, 0))"), F.lit(True))
    judged = whole.filter(alone).withColumn("cut", F.array_min(F.array(*[cut(k) for k in cuts])))
    judged = judged.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = judged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
