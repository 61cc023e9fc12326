"""Shared pieces of the text operators.

Conventions of every operator of this package, unless its docstring says otherwise:
a null text counts as the empty text, a null id is carried through like any other
value, repeated rows are separate rows, an empty table gives an empty result with
the same columns, and an input column that has the name of a result column is
replaced by it, whatever the case of its letters (as ``withColumn`` does).
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# White space that separates words, and a word as a pattern of either regex engine.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

# Texts are handed to a text function in pieces of a batch of about so many characters.
PIECE_CHARS = 4_000_000

TextFunction = Callable[[list[str]], Sequence[pa.Array]]


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z and nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def pieces(batch: pa.RecordBatch, text_col: str, limit: int = PIECE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null as empty); a slice holds one text at least, however long."""
    column = batch.column(batch.schema.get_field_index(text_col))
    start, size, texts = 0, 0, []
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if texts and size + len(text) > limit:
            yield batch.slice(start, i - start), texts
            start, size, texts = i, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield batch.slice(start), texts


def free_name(taken: Sequence[str], wish: str) -> str:
    """A column name that none of the taken ones equals, whatever the case of their letters."""
    known = {name.lower() for name in taken}
    while wish.lower() in known:
        wish = f"_{wish}"
    return wish


def without(names: Sequence[str], replaced: Iterable[str]) -> list[str]:
    """The names that no replaced name equals, whatever the case of their letters."""
    gone = {name.lower() for name in replaced}
    return [name for name in names if name.lower() not in gone]


def ship_package(spark: SparkSession) -> None:
    """Hands this library's source to the workers, once per application, as ``spark-submit --py-files`` would.

    Only the driver reads the archive's file; executors get it from Spark.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if _shipped.get(context.applicationId) or root.suffix == ".zip" or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped[context.applicationId] = True


_shipped: dict[str, bool] = {}


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this library's modules at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_texts(df: DataFrame, text_col: str, keep: Sequence[str], fields: str,
              make: Callable[[], TextFunction], piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The kept columns of every row and, after them, the columns that a text function gives.

    ``make`` is called once per task, so that tables are built (or found in the
    worker's own cache) where they are used. ``fields`` is a DDL list. The function gets
    texts of about ``piece_chars`` characters at once.
    """
    added = T.StructType.fromDDL(fields)
    kept = without(keep, added.names)
    source = df.select(*kept, *([] if text_col in kept else [text_col]))
    schema = T.StructType([source.schema[name] for name in kept] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            for piece, texts in pieces(batch, text_col, piece_chars):
                function = function or make()
                columns = [piece.column(piece.schema.get_field_index(name)) for name in kept]
                yield pa.RecordBatch.from_arrays(columns + list(function(texts)), names=schema.names)

    return map_arrow(source, run, schema)
