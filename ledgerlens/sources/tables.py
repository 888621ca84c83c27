"""Table scans, schema contracts and sinks."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: Parquet scan. Column pruning and filter pushdown happen in Catalyst;
    split sizes are the session's (``spark.sql.files.maxPartitionBytes``)."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan with fewer splits than the cluster has cores (a small table in one file) is dealt
    to all of them, by ``keys`` if given, before row-wise work; any larger scan is left where
    it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def read_tolerant(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "csv", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A1 for files that may hold bad lines: (good, bad). ``good`` has the schema's columns;
    ``bad`` is the quarantine table: the line as it stands, the file it is in. A line is bad
    if a value does not parse as its column's type or the number of values is wrong (CSV),
    or if it is no object of the schema (JSON lines). Every line but the header is in one of
    the two, whichever columns a query reads: lines are scanned as text and parsed whole."""
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*columns.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    if header and fmt == "csv":
        lines = lines.where(F.lower("value") != ",".join(columns.names).lower())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parse = {"csv": F.from_csv, "json": F.from_json}[fmt]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    rows = lines.withColumn("_row", parse("value", F.lit(ddl) if fmt == "csv" else full, options))
    bad = F.col("_row").isNull() | F.col("_row._bad").isNotNull()
    return rows.where(~bad).select(*[F.col("_row")[n].alias(n) for n in columns.names]), rows.where(bad).select(F.col("value").alias("line"), "file")


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "required") -> DataFrame:
    """A2: raise listing every missing column (plan-time check, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing {what} columns: {missing}")
    return df


def project_declared(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3: keep exactly the declared columns (after the contract check)."""
    require_columns(df, columns)
    return df.select(*columns)


def safe_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """A4: the requested columns that exist, in request order."""
    return [c for c in columns if c in df.columns]


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> str:
    """A5: overwrite a table (Parquet by default; CSV keeps a header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    """One JSON document per row (nested structs stay nested)."""
    df.write.mode("overwrite").json(path)
    return path


def write_report_set(frames: Mapping[str, DataFrame], out_dir: str, prefix: str,
                     fmt: str = "parquet") -> dict[str, str]:
    """Write a named set of frames, one table directory each; name -> path."""
    paths = {}
    for name, frame in frames.items():
        paths[name] = write_table(frame, os.path.join(out_dir, f"{prefix}_{name}"), fmt)
    return paths


def commit_report_set(frames: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> str:
    """A9 committed as a whole: every frame is written into a folder of this version, and only
    then a manifest that names them appears in one step (written beside it, then renamed). A
    reader sees the frames of the last manifest, all of one version, or none; a run that
    fails midway leaves a folder that no manifest names."""
    spark = next(iter(frames.values())).sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    paths = {name: write_table(frame, os.path.join(out_dir, "versions", version, name), fmt) for name, frame in frames.items()}
    fs, hadoop_path = _filesystem(spark, out_dir)
    final, part = (hadoop_path(os.path.join(out_dir, "manifests", f)) for f in (f"{version}.json", f".{version}.part"))
    fs.mkdirs(final.getParent())
    stream = fs.create(part, True)
    stream.write(bytearray(json.dumps({"format": fmt, "frames": {n: os.path.relpath(p, out_dir) for n, p in paths.items()}}).encode()))
    stream.close()
    if not fs.rename(part, final):
        raise OSError(f"could not commit {final}")
    return version


def read_report_set(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The frames of the last committed version; empty if there is none."""
    fs, hadoop_path = _filesystem(spark, out_dir)
    folder = hadoop_path(os.path.join(out_dir, "manifests"))
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []
    last = next((n for n in reversed(names) if n.endswith(".json")), None)
    if last is None:
        return {}
    text = "".join(r["value"] for r in spark.read.text(os.path.join(out_dir, "manifests", last)).collect())
    manifest = json.loads(text)
    return {name: spark.read.format(manifest["format"]).load(os.path.join(out_dir, path)) for name, path in manifest["frames"].items()}


def _filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class (any store that Spark writes to)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


TEXT_SUFFIX_GLOB = "*.{md,MD,Md,mD,txt,TXT,Txt,tXt,txT,TXt,TxT,tXT}"


def read_text_corpus(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Recursive .md/.txt discovery, one row per file, utf-8 decoded with
    undecodable bytes dropped (binaryFile + decode keeps bad bytes from failing
    the scan). Output: (source_path, text), one row per path: roots that repeat or
    lie within another root are dropped before the scan, so no content is shuffled."""
    roots = sorted({p.rstrip("/") for p in paths})
    roots = [p for p in roots if not any(p.startswith(q + "/") for q in roots)]
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", True)
          .option("pathGlobFilter", TEXT_SUFFIX_GLOB)
          .load(roots))
    # errors="ignore": repair to U+FFFD, then drop the replacement characters.
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\uFFFD", "")
    return df.select(F.col("path").alias("source_path"), text.alias("text"))
