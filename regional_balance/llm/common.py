"""What several operators share: written intermediate tables, free column names, text slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """Write a frame once into the shared folder, in folders of column ``by`` if given; the frame read back and its path.

    Cuts lineage: what follows survives lost executors and does not compute the frame again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def store(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``stored`` without the path, for frames that stay."""
    return stored(df, name, by)[0]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored frames that nothing reads any more."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    """Equality under which null equals null."""
    return a.eqNullSafe(b)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices, so that a batch of very long texts is not unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
