"""Byte-level BPE: encoding and decoding of whole texts by a contiguous rank array per word."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import WordCache, kind, pick, ship, strings

#: Words of more bytes are merged with a heap: scanning a rank array costs the square of its length.
SHORT = 96
#: Words whose ids a worker keeps.
CACHED = 200_000
NONE = 1 << 30

# The split pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same pattern for texts of Latin-1 characters, where the classes can be listed.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", " \\t-\\r\u0085 "
LATIN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
_latin, _any = re.compile(LATIN), regex.compile(PATTERN)
_beyond_latin = re.compile("[^\x00-\xff]")
# Letters and digits of the regex module that the tokenizers library does not know as such yet.
NEWER = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 "
    "\uab6c-\uab6d \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee "
    "\U00011b0a \U00011db0-\U00011ddb \U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f "
    "\U00012550-\U00012686 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff "
    "\U00018cd6-\U00018cda \U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 "
    "\U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 "
    "\U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed "
    "\U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead "
    "\U000323b0-\U00033479 \U0003d000-\U0003fc3f"
)
_newer = re.compile(f"[{NEWER.replace(' ', '')}]")


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    letters.update((b, chr(256 + n)) for n, b in enumerate(b for b in range(256) if b not in letters))
    return letters


class Vocabulary:
    """Merges, token bytes and special tokens of a byte-level vocabulary file (its JSON text)."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        to_byte = {c: b for b, c in byte_letters().items()}
        as_bytes = {t: bytes(map(to_byte.__getitem__, t)) for t in model["vocab"]}
        self.bytes_of = {i: as_bytes[t] for t, i in model["vocab"].items()}
        self.byte_id = [model["vocab"][c] for _, c in sorted(byte_letters().items())]
        vocab = model["vocab"]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of.update((i, t.encode()) for t, i in self.special.items())
        by_length = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, by_length)) + ")").split if by_length else None
        self.decimal = {i: str(i) for i in self.bytes_of}
        self.cache = WordCache(self._entries, CACHED)

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        rank, merged = self.rank.get, self.merged
        ranks = [rank(a << 20 | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            at = ranks.index(least)
            ids[at] = merged[least]  # the boundary between the parts at and at + 1 goes
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 20 | ids[at], NONE)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 20 | ids[at + 1], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in the same order, in n log n: a heap of pairs over a linked list."""
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := rank(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _entries(self, words: list[str]) -> list[bytes]:
        return [array("i", self.merge(w.encode())).tobytes() for w in words]

    def _words(self, piece: str) -> list[str]:
        if not _beyond_latin.search(piece):
            return _latin.findall(piece)
        if not _newer.search(piece):
            return _any.findall(piece)
        # Characters newer than the vocabulary's tables are no letters to it: split a copy without them.
        at = [m.span() for m in _any.finditer(_newer.sub("\ue000", piece))]
        return [piece[i:j] for i, j in at]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; special tokens in it become their own ids."""
        found: list[bytes] = []
        pieces = self.split_special(text) if self.split_special else [text]
        for piece in pieces:
            if piece in self.special:
                found.append(array("i", [self.special[piece]]).tobytes())
            elif piece:
                found += self.cache.values(self._words(piece))
        ids = array("i")
        ids.frombytes(b"".join(found))
        return ids.tolist()

    def written(self, ids) -> str:
        """Ids as decimals joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(content: str) -> Vocabulary:
    """The vocabulary of a file's text; a worker builds it once."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content)
    return _loaded[key]


def _with_vocabulary(spark: SparkSession, path: str):
    ship(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())  # a vocabulary file: its size does not follow the data


def encode_documents(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """Encode every whole text and decode its ids again.

    One row per input row: the id, n_tokens, ids_sha256 (ids as decimals joined by commas) and
    decoded_sha256 (UTF-8 of the decoded text); `ids` and `decoded` too if asked for. A null text
    counts as empty: 0 tokens and the digests of nothing. Special tokens in a text become their own
    ids. Null or repeated ids pass through; other columns are not looked at.
    """
    rows = pick(df, id=id_col, text=text_col)
    content = _with_vocabulary(df.sparkSession, path)
    more = [("ids", "array<int>")] * with_ids + [("decoded", "string")] * with_text
    schema = f"id {kind(rows, 'id')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += "".join(f", {n} {t}" for n, t in more)
    fields = ["n_tokens", "ids_sha256", "decoded_sha256", *[n for n, _ in more]]
    types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content.value)
        for batch in batches:
            out: dict[str, list] = {f: [] for f in fields}
            for text in strings(batch.column("text")):
                ids = v.encode(text or "")
                decoded = v.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(v.written(ids).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
                if with_text:
                    out["decoded"].append(decoded)
            columns = [batch.column("id"), *[pa.array(out[f], types.get(f, pa.string())) for f in fields]]
            yield pa.RecordBatch.from_arrays(columns, ["id", *fields])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from token ids; a null list gives an empty text, unknown ids stop the job."""
    rows = pick(df, id=id_col, ids=ids_col)
    content = _with_vocabulary(df.sparkSession, path)

    def run(batches):
        v = vocabulary(content.value)
        for batch in batches:
            texts = [v.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"id {kind(rows, 'id')}, text string").withColumnRenamed("id", id_col)
