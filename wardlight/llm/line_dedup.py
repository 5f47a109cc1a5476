"""Runs of lines that repeat in a corpus: hashes of all windows and their extensions, joined places, later copies deleted."""

from __future__ import annotations

from collections.abc import Iterator
from struct import pack

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_stage
from .common import BLANKS, kind, ship, strings

#: Words that a run of lines must hold to count as a repeat.
LEAST_WORDS = 50
_strip = BLANKS.encode()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def windows(text: str | None, least_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(fingerprint, hash, first line, number of lines) of the windows of a text and of their extensions.

    Lines without a word are passed over. The window at a line is the shortest run from there on that
    holds least_words words; its extensions are the longer runs from there that the next window does
    not reach past, so that all of them together are fewer than the lines. Two texts that share a run
    share the windows in it, and the extensions by which they cover it to its end. The fingerprint is
    the smallest line hash of the run, the hash that of all of them.
    """
    lines = [x for x in ((text or "").encode().split(b"\n")) if x.strip(_strip)]
    counts = [len(x.split()) for x in lines]
    hashes = [_signed(xxhash.xxh3_64_intdigest(x.strip(_strip))) for x in lines]
    end, held, ends = 0, 0, []
    for start, count in enumerate(counts):
        while end < len(lines) and held < least_words:
            held += counts[end]
            end += 1
        if held < least_words:
            break
        ends.append(end)
        held -= count
    for start, end in enumerate(ends):
        reach = ends[start + 1] - 1 if start + 1 < len(ends) else len(lines)
        least, whole = min(hashes[start:end]), xxhash.xxh3_64(pack(f"{end - start}q", *hashes[start:end]))
        yield least, _signed(whole.intdigest()), start, end - start
        for upto in range(end, reach):
            least = min(least, hashes[upto])
            whole.update(pack("q", hashes[upto]))
            yield least, _signed(whole.intdigest()), start, upto + 1 - start


def place_table(rows: DataFrame, least_words: int) -> DataFrame:
    """(fingerprint, window, id, text_hash, start, n): a row for every window and extension of rows (id, text_hash, text)."""
    names = ["fingerprint", "window", "start", "n"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, columns = [], [[] for _ in names]
            for row, text in enumerate(strings(batch.column("text"))):
                for found in windows(text, least_words):
                    source.append(row)
                    for column, value in zip(columns, found, strict=True):
                        column.append(value)
            taken = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(taken), batch.column("text_hash").take(taken), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["id", "text_hash", *names],
            )

    schema = f"id {kind(rows, 'id')}, text_hash bigint, fingerprint bigint, window bigint, start int, n int"
    return rows.select("id", "text_hash", "text").mapInArrow(run, schema)


def repeated_runs(places: DataFrame) -> DataFrame:
    """(id, text_hash, start, end): runs of lines that stand at an earlier place too.

    Every window and extension is matched with the first place of its own content, so a run is followed
    as far as any earlier place agrees. To the left a match is covered by the windows that start there.
    The first places are combined before the shuffle, and only runs with several places come out of
    it; the join back on them is one that adaptive execution can split.
    """
    at = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash", "start").alias("at")
    key = ["fingerprint", "window"]
    placed = places.select(*key, at, "n")
    firsts = placed.groupBy(*key).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("seen")).filter("seen > 1")
    later = placed.join(firsts.drop("seen"), key).filter(F.col("at") > F.col("first"))
    end = (F.col("at.start") + F.col("n")).cast("int").alias("end")
    return later.select("at.id", "at.text_hash", "at.start", end)


def without_lines(text: str | None, runs: list | None) -> tuple[str | None, int, int]:
    """(text without the lines of the runs, its lines with words before, how many of them went)."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip(BLANKS)]
    gone = set()
    for run in runs or ():
        gone.update(full[run["start"] : run["end"]])
    return ("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text), len(full), len(gone)


def delete_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS, counts: bool = True
) -> DataFrame:
    """df with repeated runs of lines deleted from its texts, and with `counts` also n_lines and n_deleted.

    A run of lines with words that holds least_words words or more, and stands at an earlier place too,
    goes; places are ordered by id (null last), text and line, in the texts as they came. Lines are
    compared without white space at their ends; lines without a word are passed over and stay. A text
    that repeats in whole becomes empty of such lines, but its row stays. Null and empty texts are left
    as they are. Rows with equal id and text are one place. All columns of df come along; if one of them is
    called n_lines or n_deleted, the count of that name gets an underscore behind it.
    """
    ship(df.sparkSession)
    mine = {"id": F.col(f"`{id_col}`"), "text": F.col(f"`{text_col}`").cast("string")}
    text_hash = F.xxhash64(mine["text"])
    rows = df.select(mine["id"].alias("id"), text_hash.alias("text_hash"), mine["text"].alias("text"))
    places = write_stage(place_table(rows, least_words), "windows")
    runs = repeated_runs(places).groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), mine["id"].alias("id"), text_hash.alias("text_hash"))
    runs = runs.select(F.col("id").alias("run_id"), F.col("text_hash").alias("run_hash"), "runs")
    met = whole.join(runs, whole["id"].eqNullSafe(runs["run_id"]) & (whole["text_hash"] == runs["run_hash"]), "left")
    met = met.select("row", F.col(f"row.`{text_col}`").cast("string").alias("text"), "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [without_lines(t, r) for t, r in zip(strings(batch.column("text")), batch.column("runs").to_pylist(), strict=True)]
            arrays = [pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", "text", "n_lines", "n_deleted"])

    out = met.mapInArrow(run, f"row {kind(whole, 'row')}, text string, n_lines bigint, n_deleted bigint")
    columns = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    numbers = [F.col(c).alias(f"{c}_" if c in df.columns else c) for c in ("n_lines", "n_deleted")]
    return out.select(*columns, *(numbers if counts else ()))
