"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import ensure_checkpoint_dir

#: A table of at most so many rows may be broadcast; its rows are counted first.
BROADCAST_ROWS = 100_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared
    ``spark.checkpoint.dir`` and read it back, so a lost executor costs at most
    the tasks that were running on it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcast only when a count shows at most ``rows`` rows;
    beyond that the join is left to Spark (sort-merge with skew splitting)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold: crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], size: int) -> Iterator[list[pa.Array]]:
    """The columns' rows in runs of about ``size`` bytes of the column ``text``, whatever the
    batches are; a text is never cut."""
    held, room = [], size
    for batch in batches:
        start = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
            room -= n + 8
            if room <= 0:
                held.append(batch.slice(start, i + 1 - start))
                yield [pa.chunked_array([h.column(c) for h in held]).combine_chunks() for c in columns]
                held, room, start = [], size, i + 1
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield [pa.chunked_array([h.column(c) for h in held]).combine_chunks() for c in columns]
