"""Pieces that the corpus operators share: columns by exact name, tables in the shared
folder, files in it, Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.session import scratch_dir

# Fixed value: a word is a run of other code points than these, the white space of
# ``bytes.split``. No other byte of UTF-8 looks like one of them.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, by exact name.

    Other columns never get in the way, whatever they are called, names that differ
    only in case included. The first of several columns of one name counts.
    """
    plain = df.toDF(*[f"__column_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"__column_{df.columns.index(n)}").alias(n) for n in names])


def utf8(name: str) -> Column:
    """A text as bytes, empty where it is null."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"").cast("binary")).alias(name)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, so a lost executor
    costs a read and no recomputation."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a URI or a plain path, for use inside tasks."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def shingle_hashes(words: list[bytes], size: int, seed: int) -> list[int]:
    """XXH64 of every run of ``size`` words, joined by a space, repeats included. Fewer
    words are one shingle, no words none."""
    if not words:
        return []
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    return [digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def by_batch(
    df: DataFrame, schema: str, convert: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """Map Arrow batches to columns of ``schema``, in tasks."""
    return by_task(df, schema, lambda batches: map(convert, batches))


def by_task(
    df: DataFrame,
    schema: str,
    convert: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]],
) -> DataFrame:
    """Map all Arrow batches of a task to batches of columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in convert(batches):
            arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
