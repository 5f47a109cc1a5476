"""Exact top-k search by inner product: MaxScore over shards of dimension postings, merged at the end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from .common import pick, ship

K = 20
#: Vectors in a shard, queries that a task runs over its shards together, and shards that a task takes in turn.
SHARD, QUERIES, IN_TURN = 4096, 512, 8
#: Non-essential terms probed between two looks at which candidates still compete.
PROBES = 8
EXACT = 1 << 53


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component as whole numbers."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row per block: ids and components as bytes. Blocks hold a bounded number of vectors."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        width = max(map(len, group["vector"]))
        block = np.zeros((len(group), width), np.int64)
        for at, vector in enumerate(group["vector"]):
            block[at, : len(vector)] = vector
        ids = group["id"].to_numpy(np.int64)
        return pd.DataFrame({key: group[key].iloc[:1], "width": width, "ids": [ids.tobytes()], "data": [block.tobytes()]})

    return rows.groupBy(key).applyInPandas(pack, f"{key} bigint, width int, ids binary, data binary")


class Shard:
    """Postings of one block of vectors: a term for each dimension and sign.

    The posting weight of vector x under the term (d, +) is x_d - low_d, under (d, -) high_d - x_d, so
    weights are never negative. A query component q uses the term of its sign with the weight |q|.
    """

    def __init__(self, ids: np.ndarray, block: np.ndarray):
        self.ids, self.low, self.high = ids, block.min(axis=0), block.max(axis=0)
        largest = int(np.abs(block).max(initial=0))
        self.kind, self.largest = block.dtype, largest
        self.columns = np.ascontiguousarray(block.T)
        self.doubles = self.columns.astype(np.float64)

    def search(self, query: np.ndarray, own: int, k: int, least: tuple | None) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of vectors that may be among the k best; `least` is the score to reach, if known."""
        bounds = np.abs(query) * (self.high - self.low)
        order = np.argsort(-bounds, kind="stable")
        base = int((np.where(query >= 0, self.low, self.high) * query).sum())
        exact = float(np.abs(query).max(initial=0)) * self.largest * max(1, len(query)) * 4 < EXACT
        columns, weights = (self.doubles, query.astype(np.float64)) if exact else (self.columns.astype(object), query.astype(object))
        # rest[i]: what the terms from the i-th on can add; the terms before the first i that cannot reach the bar are essential.
        rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])
        bar = None if least is None else least - base
        essential = len(order) if bar is None else int(np.argmax(rest < bar)) if (rest < bar).any() else len(order)
        if bar is not None and rest[0] < bar:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lead = order[:essential]
        scores = weights[lead] @ columns[lead] if essential else np.zeros(len(self.ids))
        shift = int((np.where(query >= 0, self.low, self.high) * query)[lead].sum())
        scores = scores - shift  # the sum of posting weights over the essential terms
        left = np.flatnonzero(self.ids != own)
        at = essential
        while True:
            bar_now = bar
            if at == len(order) and len(left) > k:
                kth = np.partition(scores[left], len(left) - k)[len(left) - k]
                bar_now = kth if bar is None else max(kth, bar)
            if bar_now is not None:
                left = left[scores[left] + rest[at] >= bar_now]
            if at == len(order) or not len(left):
                break
            terms = order[at : at + PROBES]
            part = weights[terms] @ columns[np.ix_(terms, left)]
            scores[left] += part - int((np.where(query >= 0, self.low, self.high) * query)[terms].sum())
            at += len(terms)
        return np.array([int(s) + base for s in scores[left]], np.int64), self.ids[left]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_blocks(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows (qblock, turn, shard and the bytes of both) in order; the best of each query over its run of shards."""
    key, queries, own, found = None, None, None, []

    def result() -> pd.DataFrame:
        sizes = [len(s) for s, _ in found]
        return pd.DataFrame(
            {
                "query_id": np.repeat(own, sizes),
                "vec_id": np.concatenate([i for _, i in found]),
                "score": np.concatenate([s for s, _ in found]),
            }
        )

    for batch in batches:
        for row in batch.itertuples(index=False):
            if key != (row.qblock, row.turn):
                if key is not None:
                    yield result()
                key = (row.qblock, row.turn)
                own = np.frombuffer(row.q_ids, np.int64)
                queries = np.frombuffer(row.q_data, np.int64).reshape(len(own), row.q_width)
                found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(own)
            ids = np.frombuffer(row.ids, np.int64)
            block = np.frombuffer(row.data, np.int64).reshape(len(ids), row.width)
            width = max(row.width, row.q_width)
            shard = Shard(ids, np.pad(block, ((0, 0), (0, width - row.width))))
            wide = np.pad(queries, ((0, 0), (0, width - row.q_width)))
            for at, query in enumerate(wide):
                scores, others = found[at]
                least = int(scores[-1]) if len(scores) == k else None
                more, near = shard.search(query, int(own[at]), k, least)
                if len(more):
                    found[at] = _best(np.concatenate([scores, more]), np.concatenate([others, near]), k)
    if key is not None:
        yield result()


def search(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: float = 64.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row that is_query holds for.

    The score is the inner product of floor(scale * component); ties go to the smaller id. A row never
    finds its own id. Vectors that are null or hold null or non-finite components, and rows with a null
    id, take no part; missing components of shorter vectors count as 0; rows that share an id are found
    once each. Fewer than k others give fewer rows, an empty table none. Scores beyond 64 bits are not
    defined.

    All vectors lie in shards of bounded size, dealt by a hash of a row number; queries go over all of
    them in blocks, and each task raises the score to reach from shard to shard.
    """
    ship(df.sparkSession)
    rows = pick(df.withColumn("_query_", is_query), id=id_col, vector=vector_col, asks="_query_")
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.select(F.col("id").cast("bigint").alias("id"), scaled(F.col("vector"), scale).alias("vector"), "asks")
    rows = write_stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, -(-total // SHARD)), max(1, -(-asking // QUERIES))
    index = write_stage(_packed(rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))), "shard"), "shards")
    asked = rows.filter("asks").dropDuplicates(["id", "vector"])
    asked = _packed(asked.withColumn("qblock", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))), "qblock")
    asked = asked.select("qblock", F.col("width").alias("q_width"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    met = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))).join(index, "shard")
    met = met.withColumn("turn", F.floor(F.col("shard") / IN_TURN))
    tasks = blocks * -(-shards // IN_TURN)
    dealt = met.repartition(min(tasks, 10_000), "qblock", "turn").sortWithinPartitions("qblock", "turn", "shard")
    best = dealt.mapInPandas(lambda batches: search_blocks(batches, k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
