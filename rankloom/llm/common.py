"""What the operators share: names of columns, batches of bounded size, bytes as words."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that a Python step holds as words at a time; a longer document makes a slice alone.
SLICE_BYTES = 4 << 20

_shipped: set[str] = set()


def ship(df: DataFrame) -> None:
    """Sends this package to the executors once per application, as a zip file."""
    sc: SparkContext = df.sparkSession.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="rankloom-code-")) / "rankloom-code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def fold_of(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id written as text, modulo ``folds``; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in pieces of at most ``limit`` bytes of text, or of one row."""
    column = batch.column(batch.schema.get_field_index(text))
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def column_text(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, with the memory that Arrow's pool does not need any more given back after every batch.

    A Python worker lives on from task to task, and its pool keeps what was freed: for the operator that
    comes next, the largest batches of all earlier ones would count besides its own.
    """
    def giving_back(batches):
        pool = pa.default_memory_pool()
        for out in run(batches):
            yield out
            del out
            pool.release_unused()
        pool.release_unused()

    return giving_back


def with_columns(docs: DataFrame, text: str, fields: T.StructType,
                 start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                 limit: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with further columns, computed slice by slice without moving a row.

    ``start`` is called once per task and returns the function that turns a slice into
    one array per field. A column of ``docs`` that has the name of a field is replaced.
    """
    ship(docs)
    names = {f.name for f in fields}
    kept = [c for c in docs.columns if c not in names or c == text]
    if text in names:
        raise ValueError(f"the text column may not be called {text!r}")
    source = docs.select(*kept)
    schema = T.StructType([*source.schema.fields, *fields.fields])
    arrow = [(f.name, _arrow_type(f.dataType)) for f in fields]

    def run(batches):
        step = start()
        for batch in batches:
            for piece in slices(batch, text, limit):
                arrays = [a.cast(kind) if a.type != kind else a
                          for a, (_, kind) in zip(step(piece), arrow)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *arrays], names=[*piece.schema.names, *(n for n, _ in arrow)])

    return source.mapInArrow(released(run), schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
