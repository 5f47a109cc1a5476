"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

#: ASCII white space between words, as used by the shingle and quality contracts.
BLANKS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers of a session, once.

    Workers then import its modules, wherever they run, and what a module keeps, such as a loaded
    vocabulary, lasts from task to task.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    archive = f"{work_folder(spark)}/code-{uuid.uuid4().hex}/{package.name}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(archive)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(content.getvalue())
    out.close()
    context.addPyFile(archive)  # fetched from the shared folder by every executor, also by later ones
    _shipped.add(context.applicationId)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the names the operator uses: pick(df, id="doc_id", text="text").

    Whatever else the input holds, under whatever name, cannot clash with columns that are added later.
    """
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])


def kind(df: DataFrame, name: str) -> str:
    """The type of a column, as a schema string has it."""
    return df.schema[name].dataType.simpleString()


def strings(column: pa.Array, rows: int = 512) -> Iterator[str | None]:
    """The texts of an Arrow column, of which Python holds a few rows at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


class WordCache:
    """Word -> value for the most recent words, in two generations, so that memory stays bounded.

    When the young generation is full it becomes the old one; a word found only there moves back.
    """

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit
        self.young: dict = {}
        self.old: dict = {}

    def values(self, words: list) -> list:
        """The value of every word, in order; what is not known is made for all of them at once."""
        found = [*map(self.young.get, words)]
        if None not in found:
            return found
        gaps = [i for i, value in enumerate(found) if value is None]
        if gaps:
            missing = {words[i] for i in gaps}
            if len(self.young) + len(missing) > self.limit:
                self.old, self.young = self.young, {}
            known, old = self.young, self.old
            new = [w for w in missing if w not in old]
            known.update((w, old[w]) for w in missing if w in old)
            if new:
                known.update(zip(new, self.make(new), strict=True))
            for i in gaps:
                found[i] = known[words[i]]
        return found
