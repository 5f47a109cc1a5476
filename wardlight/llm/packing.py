"""Best-fit decreasing packing of tokenized texts into sequences of bounded length."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_stage
from .common import WordCache, kind, pick, ship, strings

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs. A group leaves one sequence or so unfilled, so the loss is a few in ten thousand.
PER_GROUP = 20_000
CACHED = 300_000
#: Parts of words that the library gets at once.
TOGETHER = 256

# The split pattern of the vocabulary over lower-case Latin-1 letters, whose classes can be listed.
_L, _N = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
LATIN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_L}{_N}]+"
_latin = re.compile(LATIN)
#: A run of marks that ends in a comma or stop.
_run = re.compile(rf"[^{_L}{_N} \t\n\r][,.][ \n]")
#: Characters that Python and the library normalise and classify alike.
_plain = re.compile("[\t\n\r -~¡-¬®-ÿ]*")


class TextIds:
    """Ids of whole texts by the tokenizers library; words of plain texts are encoded once and kept."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of a node share its cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache = WordCache(self._words, CACHED)
        self.parts = WordCache(self._parts, 2 * CACHED)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part; many go to the library as one text, and come apart by the numbers of its words."""
        out = []
        for start in range(0, len(parts), TOGETHER):
            some = parts[start : start + TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, ends = np.array(found.ids, "<u4").tobytes(), 4 * np.cumsum(np.bincount(found.word_ids))
            if len(ends) != len(some):
                out += map(self._ids, some)
                continue
            ends = [0, *ends.tolist()]
            out += [ids[i:j] for i, j in zip(ends, ends[1:], strict=False)]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        split = [_latin.findall(w) for w in words]
        ids = iter(self.parts.values([p for parts in split for p in parts]))
        return [b"".join(itertools.islice(ids, len(parts))) for parts in split]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if "<|" in text or not _plain.fullmatch(text):
            return self._ids(text)
        text = text.lower()
        if not _run.search(text):  # a mark that ends a word alone is a part of its own anyway; apart, words repeat more often
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
        words = text.split()  # merges never reach over white space, so each word has ids of its own
        return b"".join(self.cache.values(words))


_loaded: dict[str, TextIds] = {}


def text_ids(content: str) -> TextIds:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = TextIds(content)
    return _loaded[key]


def token_pieces(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32.

    A text's ids are followed by end_id; only longer ones are cut, into pieces of `capacity`. A null or
    empty text is one piece that holds end_id alone. Null and repeated ids give their own pieces.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col)
    with open(path, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: its size does not follow the data
    end = np.array([end_id], "<u4").tobytes()
    names = ["piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_ids(content.value)
        for batch in batches:
            source, values = array("q"), [array("q") for _ in names]
            for row, text in enumerate(strings(batch.column("text"))):
                ids = coder.encode(text or "") + end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    source.append(row)
                    for column, value in zip(values, (piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            taken = batch.column("id").take(pa.array(np.frombuffer(source, "q") if source else [], pa.int64()))
            columns = [pa.array(np.frombuffer(v, "q") if v else [], pa.int64()) for v in values]
            columns[0] = columns[0].cast(pa.int32())
            yield pa.RecordBatch.from_arrays([taken, *columns], ["id", *names])

    schema = f"id {kind(rows, 'id')}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


class OpenBins:
    """A segment tree over remaining capacities: each node counts the open bins below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.bins[room].pop()

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, length: int) -> int:
        """The smallest room of at least `length` that an open bin has, or -1."""
        count, node = self.count, length + self.leaves
        if count[node]:
            return length
        while node > 1:
            if not node & 1 and count[node + 1]:  # a left child whose right sibling holds larger rooms
                node += 1
                break
            node >>= 1
        else:
            return -1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; lengths are 1 to capacity. Equal lengths keep their order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, used = OpenBins(capacity), 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        room = tree.tightest(length)
        if room < 0:
            number, room, used = used, capacity, used + 1
        else:
            number = tree.take(room)
        bins[at], offsets[at] = number, capacity - room
        if room > length:
            tree.put(room - length, number)
    return bins, offsets


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PER_GROUP) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` from 1 to capacity.

    The rows are dealt into groups of about per_group by a hash of their number, whatever their ids, and
    each group is packed by best-fit decreasing. No rows give no rows. The pieces are written out
    first, so that the number of groups follows their count and a lost executor repeats one group only.
    """
    ship(pieces.sparkSession)
    kept = write_stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.count() // per_group))
    dealt = kept.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row")
        bins, offsets = best_fit_decreasing(group["length"].to_numpy(), capacity)
        group["sequence_id"] = (group["_group"].to_numpy() << 32) + bins
        group["offset"] = offsets
        return group.drop(columns=["_row", "_group"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_group").applyInPandas(pack, schema + ", sequence_id bigint, offset bigint")


def pack_documents(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Tokenize, cut and pack whole texts: the columns of token_pieces, sequence_id and offset."""
    return pack_pieces(token_pieces(df, path, id_col, text_col, capacity, end_id), capacity)
