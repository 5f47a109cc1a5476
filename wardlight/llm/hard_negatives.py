"""Hard negatives of anchors by exact inner products, filtered by summaries of vector segments.

Every vector is cut into segments of which the mean and the deviation are stored. Over a segment of n
components <x, q> = n mean(x) mean(q) + <x - mean(x), q - mean(q)>, and by Cauchy and Schwarz the last part is
at most n dev(x) dev(q) either way. Sums over the segments bound the score from both sides; finer segments
bound it more tightly, and only pairs that pass the finest are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from .common import pick, ship
from .top_k import scaled, usable

K_POSITIVES, K_NEGATIVES = 5, 5
#: Least share of the positive's score that a negative has, in percent.
LEAST_PERCENT = 80
#: Vectors in a shard, anchors in a block, anchors that are compared at a time, shards that a task takes in turn.
#: Small tables get smaller shards and shorter turns, down to LEAST_SHARD vectors, so that all cores have work.
SHARD, ANCHORS, AT_ONCE, IN_TURN, LEAST_SHARD = 16384, 8192, 128, 8, 1024
#: Segments of the finest summary, and how many of them make one segment at each level, coarse levels first.
SEGMENTS, LEVELS = 16, (8, 2, 1)
#: Share of pairs beyond which a whole matrix product is cheaper than single ones; components of single ones held at a time.
DENSE, HELD = 0.05, 1 << 22
#: Rounding allowance of the bounds, relative to the lengths of both vectors; summaries are stored as 32-bit numbers.
SLACK = 1e-5
NOTHING = -(1 << 62)


def _narrow(block: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    largest = int(np.abs(block).max(initial=0))
    return block.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max))


def summaries(block: np.ndarray) -> np.ndarray:
    """(rows, 2, SEGMENTS): mean and deviation of each of the finest segments; the width is a multiple of SEGMENTS."""
    parts = block.reshape(len(block), SEGMENTS, -1).astype(np.float64)
    return np.stack([parts.mean(2), parts.std(2)], 1).astype(np.float32)


def coarser(fine: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of segments made of `times` finer ones each."""
    mean, dev = fine.astype(np.float64).reshape(len(fine), 2, -1, times).transpose(1, 0, 2, 3)
    whole = mean.mean(2)
    return whole, np.sqrt((dev**2).mean(2) + ((mean - whole[:, :, None]) ** 2).mean(2))


def _packed(rows: DataFrame, key: str, width: int) -> DataFrame:
    """One row per block of a bounded number of rows: numbers, ids, labels, components and summaries as bytes."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        block = np.zeros((len(group), width), np.int64)
        for at, vector in enumerate(group["vector"]):
            block[at, : len(vector)] = vector
        small = _narrow(block)
        numbers = {n: [group[n].to_numpy(np.int64).tobytes()] for n in ("row", "id", "label")}
        return pd.DataFrame(
            {key: group[key].iloc[:1], **numbers, "kind": small.dtype.str, "data": [small.tobytes()], "fine": [summaries(block).tobytes()]}
        )

    parts = "row binary, id binary, label binary, kind string, data binary, fine binary"
    return rows.groupBy(key).applyInPandas(pack, f"{key} bigint, {parts}")


class Block:
    """Vectors of a packed row with their summaries at all levels."""

    def __init__(self, row, prefix: str = ""):
        def get(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(getattr(row, prefix + name), kind)

        self.row, self.id, self.label = (get(n, np.int64) for n in ("row", "id", "label"))
        n = len(self.row)
        self.data = get("data", getattr(row, prefix + "kind")).reshape(n, -1)
        self.norm = np.sqrt((self.data.astype(np.float64) ** 2).sum(1))
        fine = get("fine", np.float32).reshape(n, 2, SEGMENTS)
        self.levels = [coarser(fine, times) for times in LEVELS]

    def part(self, at) -> Block:
        """Some of the rows."""
        new = object.__new__(Block)
        new.row, new.id, new.label, new.data, new.norm = (x[at] for x in (self.row, self.id, self.label, self.data, self.norm))
        new.levels = [(mean[at], dev[at]) for mean, dev in self.levels]
        return new


def scores_near(anchors: Block, others: Block, low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, other, score) of the allowed pairs whose score may lie between low and high in some slot.

    low and high are (anchors, slots). Nothing that lies in a slot is left out; other pairs may be among the result.
    """
    alive, width = np.arange(len(others.row)), others.data.shape[1]
    slack = SLACK * anchors.norm[:, None] * others.norm[None, :] + 0.5
    for (mean, dev), (own_mean, own_dev) in zip(others.levels, anchors.levels, strict=True):
        size = width // mean.shape[1]
        middle = size * (own_mean @ mean[alive].T)
        spread = size * (own_dev @ dev[alive].T) + slack[:, alive]
        most, least = middle + spread, middle - spread
        fits = np.zeros(most.shape, bool)
        for slot in range(low.shape[1]):
            fits |= (most >= low[:, slot, None]) & (least <= high[:, slot, None])
        allowed = allowed & fits
        kept = allowed.any(0)
        alive, allowed = alive[kept], allowed[:, kept]
        if not len(alive):
            break
    at, other = np.nonzero(allowed)
    if allowed.size and len(at) > DENSE * allowed.size:
        score = (anchors.data.astype(np.float64) @ others.data[alive].astype(np.float64).T)[at, other]
    else:
        score = np.empty(len(at))
        step = max(1, HELD // width)
        for start in range(0, len(at), step):
            some = slice(start, start + step)
            left, right = anchors.data[at[some]].astype(np.float64), others.data[alive[other[some]]].astype(np.float64)
            score[some] = np.einsum("ij,ij->i", left, right)
    return at, alive[other], score.astype(np.int64)


class Best:
    """The k best rows of every anchor and slot so far: highest scores first, ties to smaller ids."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = np.full((*low.shape, k), NOTHING, np.int64)
        self.id = np.zeros((*low.shape, k), np.int64)

    def bar(self, some: slice) -> np.ndarray:
        """The least score that still counts in each slot."""
        return np.maximum(self.low[some], self.score[some, :, -1])

    def add(self, start: int, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        for slot in range(self.low.shape[1]):
            here = at + start
            fits = (score >= np.maximum(self.low[here, slot], self.score[here, slot, -1])) & (score <= self.high[here, slot])
            anchor, new, key = here[fits], score[fits], ids[fits]
            touched = np.unique(anchor)
            old_at, old = np.nonzero(self.score[touched, slot] > NOTHING)
            old_at = touched[old_at]
            anchor = np.concatenate([anchor, old_at])
            new, key = np.concatenate([new, self.score[old_at, slot, old]]), np.concatenate([key, self.id[old_at, slot, old]])
            order = np.lexsort((key, -new, anchor))
            anchor, new, key = anchor[order], new[order], key[order]
            place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
            first = place < self.k
            self.score[anchor[first], slot, place[first]] = new[first]
            self.id[anchor[first], slot, place[first]] = key[first]

    def rows(self, anchors: Block) -> pd.DataFrame:
        at, slot, place = np.nonzero(self.score > NOTHING)
        return pd.DataFrame({"row": anchors.row[at], "slot": slot, "id": self.id[at, slot, place], "score": self.score[at, slot, place]})


def search_shard(anchors: Block, shard: Block, best: Best, same_label: bool) -> None:
    """Go over one shard for all anchors of a block, a few anchors at a time; anchors lie in the order of their labels."""
    for start in range(0, len(anchors.row), AT_ONCE):
        some = slice(start, start + AT_ONCE)
        few = anchors.part(some)
        here = shard.part(np.isin(shard.label, few.label)) if same_label else shard
        alike = few.label[:, None] == here.label[None, :]
        allowed = (alike if same_label else ~alike) & (few.id[:, None] != here.id[None, :])
        at, other, score = scores_near(few, here, best.bar(some), best.high[some], allowed)
        if len(at):
            best.add(start, at, here.id[other], score)


def search_blocks(batches: Iterator[pd.DataFrame], k: int, same_label: bool) -> Iterator[pd.DataFrame]:
    """Rows (block, turn, shard and the bytes of both) in order; the best of each anchor over its run of shards."""
    key, anchors, best = None, None, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if key != (row.block, row.turn):
                if key is not None:
                    yield best.rows(anchors)
                key, anchors = (row.block, row.turn), Block(row, "a_")
                n = len(anchors.row)
                low, high = (np.frombuffer(getattr(row, x), np.int64).reshape(n, -1) for x in ("a_low", "a_high"))
                by_label = np.argsort(anchors.label, kind="stable")
                anchors, best = anchors.part(by_label), Best(low[by_label], high[by_label], k)
            search_shard(anchors, Block(row), best, same_label)
    if key is not None:
        yield best.rows(anchors)


def _meet(anchors: DataFrame, shards: DataFrame, n_blocks: int, n_shards: int, k: int, same_label: bool) -> DataFrame:
    """(row, slot, id, score): the best of every anchor and slot in each run of shards."""
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_shards - 1).cast("bigint")))
    cores = anchors.sparkSession.sparkContext.defaultParallelism
    in_turn = max(1, min(IN_TURN, n_blocks * n_shards // (2 * cores)))
    met = anchors.withColumn("shard", every).join(shards, "shard").withColumn("turn", F.floor(F.col("shard") / in_turn))
    tasks = n_blocks * -(-n_shards // in_turn)
    dealt = met.repartition(min(tasks, 10_000), "block", "turn").sortWithinPartitions("block", "turn", "shard")
    return dealt.mapInPandas(lambda batches: search_blocks(batches, k, same_label), "row bigint, slot int, id bigint, score bigint")


def _with_ranges(blocks: DataFrame, ranges: DataFrame | None) -> DataFrame:
    """Add to each block of anchors the range of scores that counts in each slot, as bytes.

    ranges: (block, row, slot, low, high), at most a few rows for each anchor. Without ranges every score
    counts; slots that an anchor lacks are empty.
    """
    n_slots = 1 if ranges is None else K_POSITIVES if ranges.isEmpty() else ranges.agg(F.max("slot")).first()[0] + 1

    def fill(rows: np.ndarray, found: pd.DataFrame | None) -> tuple[bytes, bytes]:
        low, high = np.full((len(rows), n_slots), -NOTHING, np.int64), np.full((len(rows), n_slots), NOTHING, np.int64)
        if found is None:
            low[:], high[:] = NOTHING, -NOTHING
        else:
            at, slot = np.searchsorted(rows, found["row"].to_numpy(np.int64)), found["slot"].to_numpy()
            low[at, slot], high[at, slot] = found["low"], found["high"]
        return low.tobytes(), high.tobytes()

    names = ["row", "id", "label", "kind", "data", "fine"]
    schema = "block bigint, row binary, id binary, label binary, kind string, data binary, fine binary, low binary, high binary"

    def add(blocks: pd.DataFrame, found: pd.DataFrame | None) -> pd.DataFrame:
        both = [fill(np.frombuffer(r, np.int64), found) for r in blocks["row"]]
        return blocks.assign(low=[b[0] for b in both], high=[b[1] for b in both])[["block", *names, "low", "high"]]

    if ranges is None:
        made = blocks.mapInPandas(lambda batches: (add(b, None) for b in batches), schema)
    else:
        made = blocks.groupBy("block").cogroup(ranges.groupBy("block")).applyInPandas(add, schema)
    return made.select("block", *[F.col(c).alias(f"a_{c}") for c in [*names, "low", "high"]])


def mine(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    positives: int = K_POSITIVES,
    negatives: int = K_NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor row.

    The score of a row is its inner product with the anchor over floor(scale * component); higher scores
    come first, ties go to the smaller id. The positives are the first rows with the anchor's label; the
    negatives of a positive are the first rows of other labels whose score is at most that of the positive
    and at least least_percent of it. A positive with a score below 0 has none.

    Rows with a null id, label or vector, or with null or non-finite components take no part. Missing
    components of shorter vectors count as 0. A row never meets rows of its own id; rows that share an id
    are found once each, and each is an anchor of its own. An empty table gives no rows. Scores are exact
    below 2^53.

    All vectors lie in shards of bounded size, dealt by a hash of the row number whatever their labels, so
    a label that most rows share makes no large group. Blocks of anchors pass all shards, twice: for the
    positives, then for the negatives between the bounds that these set.
    """
    ship(df.sparkSession)
    rows = pick(df.withColumn("_anchor_", is_anchor), id=id_col, vector=vector_col, label=label_col, asks="_anchor_")
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), scaled(F.col("vector"), scale).alias("vector"), "asks")
    rows = write_stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total, asking, width = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("vector"))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_shards = max(1, -(-total // SHARD), min(2 * cores, -(-total // LEAST_SHARD)))
    n_blocks = max(1, -(-asking // ANCHORS))
    width = SEGMENTS * max(1, -(-(width or 0) // SEGMENTS))
    shards = write_stage(_packed(rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards))), "shard", width), "shards")
    asked = rows.filter("asks").withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks)))
    blocks = write_stage(_packed(asked, "block", width), "anchors")

    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    near = _meet(_with_ranges(blocks, None), shards, n_blocks, n_shards, positives, True)
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    near = near.join(asked.select("row", "block", F.col("id").alias("anchor_id")), "row")
    near = write_stage(
        near.select("block", "row", "anchor_id", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # The least whole score that is least_percent of the positive's, rounded up in whole numbers.
    least = F.expr(f"({least_percent} * cast(positive_score as decimal(38, 0)) + 99) div 100")
    ranges = near.filter("positive_score >= 0").select("block", "row", "slot", least.alias("low"), F.col("positive_score").alias("high"))
    far = _meet(_with_ranges(blocks, ranges), shards, n_blocks, n_shards, negatives, False)
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    found = far.join(near.drop("block"), ["row", "slot"])
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
