"""What several operators share: whole-text slices of a batch, written intermediates."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from daybook.session import shared_folder

# The word of every contract: a run of code points other than ASCII white space.
# ``bytes.split()`` without an argument splits UTF-8 text in the same places.
SPACE_CLASS = r"[ \t-\r]"
SLICE_BYTES = 4 << 20


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a Parquet table in the folder all executors share.

    The plan starts anew from the files, so a lost executor costs at most the
    tasks that read them, and nothing below is computed twice.
    """
    path = shared_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more, and let Spark remove the
    shuffles of plans that are gone: it does so when the driver collects them, which a
    driver with little else to do puts off."""
    for table in tables:
        spark = table.sparkSession
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    SparkSession.active()._jvm.System.gc()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8_texts(values: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [v if v is not None else b"" for v in values.cast(pa.binary()).to_pylist()]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the named column holds about ``most`` bytes.

    A single longer text is a slice of its own: texts are never divided.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(column(batch, text)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
