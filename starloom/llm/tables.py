"""Small helpers that several operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words in all contracts that speak of ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"

#: Text bytes that one step of a Python operator handles at once.
SLICE_BYTES = 4 << 20


def read(spark, sf_dir: str, table: str) -> DataFrame:
    """A table as it lies in the input folder, or in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns under names of our own, so that others cannot clash.

    Columns are looked up by exact name first: ``doc_id`` is not mistaken for an
    extra ``DOC_ID``.
    """
    return positional(df).select(*[_at(df, name).alias(own) for own, name in columns.items()])


def _at(df: DataFrame, name: str) -> Column:
    return F.col(f"_c{df.columns.index(name)}")


def positional(df: DataFrame) -> DataFrame:
    """The columns renamed by position: ``_c0``, ``_c1`` and so on."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of exactly these names."""
    keep = [i for i, name in enumerate(df.columns) if name not in names]
    return positional(df).select(*[f"_c{i}" for i in keep]).toDF(*[df.columns[i] for i in keep])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression that a lambda mentions is computed for every element; bound to
    a lambda variable of its own it is computed once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_slices(batches: Iterator[pa.RecordBatch], at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that column ``at`` (strings) has about ``most`` bytes in each.

    A single longer text is a slice of its own.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(at)).fill_null(0).to_pylist()
        begin, held = 0, 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > most:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def as_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    """A record batch of Python lists or arrays, in the schema's types."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


_shipped: set[str] = set()


def ship(spark) -> None:
    """Give this package to the executors' Python, once per application.

    Executors need not have it installed, and need not share a folder with the driver.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp()  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = f"{folder}/starloom-{context.applicationId}.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted((top / "starloom").rglob("*.py")):
            archive.write(file, file.relative_to(top))
    context.addPyFile(packed)
    _shipped.add(context.applicationId)
