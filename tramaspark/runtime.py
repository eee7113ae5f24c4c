"""Session helpers: reading tables, cutting lineage and joining against skewed keys."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: spark.checkpoint.dir, which all executors of a cluster share.

    Only where the session names none (tests on local masters) is a temporary folder made, once per session.
    """
    said = spark.conf.get("spark.checkpoint.dir", None)
    if not said:
        said = spark.sparkContext.getCheckpointDir()
    if not said:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
        said = tempfile.mkdtemp(prefix="trama-")
        spark.sparkContext.setCheckpointDir(said)
        said = spark.sparkContext.getCheckpointDir() or said
    return said.rstrip("/")


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """Write df as parquet in the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trama/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    return stored(df)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables made by stored() that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(conf).delete(where, True)


def release(spark: SparkSession, *paths: str) -> None:
    """discard(), and have Spark delete the shuffle files of finished jobs: it does so only once the driver has collected its garbage."""
    discard(spark, *paths)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return c.isNull() | (F.trim(F.regexp_replace(c, r"(?U)\s+", " ")) == "")


#: Hot keys whose rows lookup() broadcasts, at most.
MOST_HOT = 10_000


def lookup(left: DataFrame, right: DataFrame, key: str, hot_rows: int = 200_000, how: str = "left", rows: int | None = None, most_hot: int = MOST_HOT, counted: DataFrame | None = None) -> DataFrame:
    """Join left to right, of which `key` is unique, without sending the rows of a hot key to one task.

    A key that more than `hot_rows` rows of left carry is hot, and the hottest `most_hot` of these are joined by a broadcast
    of their rows of right: one each, so that the bound on their number is what makes the broadcast safe however the data
    grow. A hot key beyond these has at most 1 / most_hot of left's rows and is joined by the shuffle like all other keys.
    Null keys match nothing; with how='left' they stay. rows: the number of rows of left where it is known, by which the
    count per key is spared if no key can be hot. counted: a table that is cheaper to count and has no key fewer times than left.
    """
    if rows is not None and rows <= hot_rows:
        return left.join(right, key, how)
    counts = (left if counted is None else counted).groupBy(key).count().where((F.col("count") > hot_rows) & F.col(key).isNotNull())
    hot = [r[0] for r in counts.orderBy(F.desc("count"), key).limit(most_hot).collect()]
    if not hot:
        return left.join(right, key, how)
    hot_df = left.sparkSession.createDataFrame([(h,) for h in hot], f"{key} {dict(left.dtypes)[key]}")
    marked = left.join(F.broadcast(hot_df.withColumn("__hot", F.lit(True))), key, "left")
    cold = marked.where(F.col("__hot").isNull()).drop("__hot").join(right, key, how)
    warm = marked.where(F.col("__hot").isNotNull()).drop("__hot")
    return cold.unionByName(warm.join(F.broadcast(right.join(F.broadcast(hot_df), key, "left_semi")), key, how))


def rows_per_task(n: int, per_task: int, least: int = 1) -> int:
    return max(least, -(-n // per_task))


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def data_path(*parts: str) -> str:
    return os.path.join(os.path.dirname(__file__), *parts)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context, by way of the shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_trama_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    where = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/trama/package-{uuid.uuid4().hex}.zip")
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(where)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(fs.makeQualified(where).toString())
    sc._trama_shipped = True


def shipped(query):
    """A query (spark, directory) that first sends the package along."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        ship(spark)
        return query(spark, directory)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
