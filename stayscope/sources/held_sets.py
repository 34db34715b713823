"""Held sets: keyed tables that take new rows in without being written anew.

A set is a Parquet table partitioned by a bucket of its key's hash. Loading a
batch reads and writes only the buckets that the batch touches; the files of
the others stay as they are. Each load writes its buckets under a new version
and then, as its last step, a small table that says which version of each
bucket holds. A reader takes the newest such table, so a load that dies
half-way leaves the set as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stayscope.operators.upsert import keep_last_by_key
from stayscope.sources.files import write_table

#: Buckets of a new set: at 1000 executors about one for each; fixed for the life of the set.
BUCKETS = 1024
VERSIONS = "bucket int, version int, rows bigint"


def _bucket(key: str, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _last_version(spark: SparkSession, folder: str) -> int | None:
    """The newest version whose table of buckets is whole: the mark of success is written last."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    found = [int(s.getPath().getName().removeprefix("v")) for s in files.listStatus(place)]
    whole = [v for v in found if _exists(spark, f"{folder}/versions/v{v}/_SUCCESS")]
    return max(whole, default=None)


def bucket_versions(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """bucket, version, rows: which version of each bucket holds, in the newest or a given version of the set."""
    last = _last_version(spark, folder) if version is None else version
    if last is None:
        raise ValueError(f"there is no set in {folder}")
    return spark.read.schema(VERSIONS).parquet(f"{folder}/versions/v{last}")


def _held(spark: SparkSession, folder: str, schema: T.StructType, now: DataFrame) -> DataFrame:
    """The rows of the buckets that hold; buckets and versions are folders, so only these are listed and read."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType()),
                                           T.StructField("_version", T.IntegerType())])).parquet(f"{folder}/rows")
    # A row per bucket: a bounded table, whose values prune the folders before the scan.
    by_version: dict[int, list[int]] = {}
    for row in now.filter("rows > 0").collect():
        by_version.setdefault(row.version, []).append(row.bucket)
    wanted = F.lit(False)
    for version, buckets in sorted(by_version.items()):
        wanted |= (F.col("_version") == version) & F.col("_bucket").isin(sorted(buckets))
    return rows.filter(wanted)


def read_set(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of a set, as of its newest version or of a given one; the reader stays with that version."""
    now = bucket_versions(spark, folder, version)
    schema = spark.read.parquet(f"{folder}/schema").schema
    return _held(spark, folder, schema, now).drop("_bucket", "_version")


def load(
    batch: DataFrame, folder: str, key: str, order_cols: list[str], deleted_col: str | None = None, buckets: int = BUCKETS,
) -> dict[str, int]:
    """Take a batch into the set of a folder; a new folder becomes a set. Returns version, rows and touched buckets.

    A row of the batch replaces the set's row of its key; of several in the
    batch the greatest by `order_cols` stays. A row whose `deleted_col` is true
    takes its key out. Rows without a key raise. The batch has the columns of
    the set. Loads into one set go one after another.
    """
    spark = batch.sparkSession
    last = _last_version(spark, folder)
    version = 0 if last is None else last + 1
    if last is None:
        write_table(batch.drop(deleted_col or "").limit(0), f"{folder}/schema")
        now = spark.createDataFrame([(i, 0, 0) for i in range(buckets)], VERSIONS)
    else:
        now = bucket_versions(spark, folder)
        buckets = now.count()
    schema = spark.read.parquet(f"{folder}/schema").schema
    names = schema.fieldNames()
    if set(batch.columns) - {deleted_col} != set(names):
        raise ValueError(f"the set has the columns {names}, the batch {batch.columns}")
    gone = F.coalesce(F.col(deleted_col), F.lit(False)) if deleted_col else F.lit(False)
    keyed = F.when(F.col(key).isNull(), F.raise_error(F.lit("a row of the batch has no key"))).otherwise(F.col(key))
    rows = batch.withColumns({"_gone": gone, key: keyed})
    rows = keep_last_by_key(rows, key, order_cols).select(*names, "_gone", _bucket(key, buckets).alias("_bucket"))
    incoming = f"{folder}/incoming/v{version}"
    write_table(rows, incoming)
    rows = spark.read.parquet(incoming)
    touched = [r._bucket for r in rows.select("_bucket").distinct().collect()]
    merged = rows.filter("not _gone").drop("_gone")
    if last is not None:
        old = _held(spark, folder, schema, now.filter(F.col("bucket").isin(touched))).drop("_version")
        merged = merged.unionByName(old.join(rows.select(key, "_bucket"), [key, "_bucket"], "left_anti").select(*names, "_bucket"))
    # By bucket and key, so that a bucket may be written by several tasks and stays in key order.
    merged = merged.repartitionByRange("_bucket", key).sortWithinPartitions("_bucket", key)
    # A version that a dead load left behind is written over.
    target = f"{folder}/rows/_version={version}"
    merged.write.mode("overwrite").partitionBy("_bucket").parquet(target)
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(target)
    counted = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"))
    changed = spark.createDataFrame([(b,) for b in touched], "bucket int").join(
        counted.withColumnRenamed("_bucket", "bucket"), "bucket", "left"
    ).select("bucket", F.lit(version).alias("version"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))
    table = changed.unionByName(now.filter(~F.col("bucket").isin(touched)))
    write_table(table.coalesce(1), f"{folder}/versions/v{version}")
    total = spark.read.parquet(f"{folder}/versions/v{version}").agg(F.sum("rows")).first()[0]
    return {"version": version, "rows": total, "buckets": len(touched)}


def remove_old_versions(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete what only versions before the last `keep` need; returns the folders deleted. No reader may hold those."""
    last = _last_version(spark, folder)
    if last is None:
        return 0
    needed, hadoop = set(), spark._jvm.org.apache.hadoop.fs
    for version in range(max(0, last - keep + 1), last + 1):
        if _exists(spark, f"{folder}/versions/v{version}/_SUCCESS"):
            needed |= {(r.version, r.bucket) for r in bucket_versions(spark, folder, version).collect()}
    deleted = 0
    for version in range(last + 1):
        place = hadoop.Path(f"{folder}/rows/_version={version}")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            for entry in files.listStatus(place):
                name = entry.getPath().getName()
                if name.startswith("_bucket=") and (version, int(name.removeprefix("_bucket="))) not in needed:
                    deleted += files.delete(entry.getPath(), True)
        files.delete(hadoop.Path(f"{folder}/incoming/v{version}"), True)
        if version <= last - keep:
            files.delete(hadoop.Path(f"{folder}/versions/v{version}"), True)
    return deleted
