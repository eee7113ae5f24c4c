"""Continuous upserts: deliveries of records as a stream, the newest row of each key as a table.

There is no watermark: a delivery counts however late it comes, and of two with one time the choice is that of latest().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.latest import latest

BUCKETS = 64


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def into_table(stream: DataFrame, path: str, checkpoint: str, key: str, ts: str, buckets: int = BUCKETS) -> DataStreamWriter:
    """Each batch is merged with the table in `path`: of every key the newest row stays. Rows without key are left out.

    Keys are hashed into buckets, and a batch reads and writes again only the buckets it touches, in a folder of its own
    number; of every bucket the highest complete number holds. A batch that is run again writes the same folder again. A
    bucket's folder is deleted once two later batches have written it anew, so that readers of the last one are not disturbed.
    The number of buckets belongs to the table and may not change.
    """
    cols = [c for c in stream.columns if c != key]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col(key).isNotNull()).withColumn("bucket", _bucket(key, buckets)).persist()
        try:
            touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())
            if not touched:
                return
            before = _held(spark, path, below=number)
            old = [before[b][0] for b in touched if b in before]
            whole = rows.drop("bucket")
            if old:
                whole = whole.unionByName(spark.read.schema(whole.schema).parquet(*old))
            new = latest(whole, key, ts, cols).withColumn("bucket", _bucket(key, buckets))
            new.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/v={number:012d}")
            _delete(spark, [p for b in touched for p in before.get(b, [])[1:]])
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _held(spark: SparkSession, path: str, below: int | None = None) -> dict[int, list[str]]:
    """The folders of every bucket in complete versions, the newest first."""
    at, fs = _fs(spark, path)
    out: dict[int, list[str]] = {}
    if not fs.exists(at):
        return out
    names = sorted((s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("v=")), reverse=True)
    for name in names:
        folder, _ = _fs(spark, f"{path}/{name}")
        inside = {s.getPath().getName() for s in fs.listStatus(folder)}
        if "_SUCCESS" in inside and (below is None or int(name[2:]) < below):
            for one in sorted(inside):
                if one.startswith("bucket="):
                    out.setdefault(int(one[7:]), []).append(f"{path}/{name}/{one}")
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        at, fs = _fs(spark, p)
        fs.delete(at, True)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as the last complete batches left it, or None if there is none yet."""
    held = _held(spark, path)
    return spark.read.parquet(*[folders[0] for _, folders in sorted(held.items())]) if held else None
