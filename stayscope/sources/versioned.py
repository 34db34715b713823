"""Tables that are replaced as a whole or not at all.

A replace writes its tables into a new folder `v<n>` and then, as its last
step, makes the empty file `holds/<n>`. Readers take the newest version with
such a file and stay with it, so a job that dies half-way leaves what was
there, and a running reader never sees another version's files. Several tables
replaced together change together. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayscope.sources.files import write_table


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    place, files = _hadoop(spark, path)
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


def last_version(spark: SparkSession, folder: str) -> int | None:
    """The newest version that holds; None if there is none."""
    return max(_numbers(spark, f"{folder}/holds"), default=None)


def replace_tables(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> int:
    """Write all tables as one new version, which holds once all are written. Returns its number.

    The tables may be made from those of the version before. The folder of a
    job that died is not used again.
    """
    used = _numbers(spark, folder, "v") + _numbers(spark, f"{folder}/holds")
    version = max(used, default=-1) + 1
    for name, df in tables.items():
        write_table(df, f"{folder}/v{version}/{name}")
    place, files = _hadoop(spark, f"{folder}/holds/{version}")
    if not files.createNewFile(place):
        raise ValueError(f"version {version} of {folder} was written by another job")
    return version


def read_version(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the newest version, or of a given one."""
    held = _numbers(spark, f"{folder}/holds")
    found = max(held, default=None) if version is None else version
    if found not in held:
        raise ValueError(f"{folder} has no version {'' if version is None else version}".rstrip())
    return spark.read.parquet(f"{folder}/v{found}/{name}")


def remove_versions(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all but the last `keep` versions that hold, and what dead jobs left; returns the folders deleted.

    No reader or writer may use those.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    kept = _numbers(spark, f"{folder}/holds")[-keep:]
    gone = [v for v in _numbers(spark, folder, "v") if v not in kept]
    for version in gone:
        for path in (f"{folder}/holds/{version}", f"{folder}/v{version}"):
            place, files = _hadoop(spark, path)
            files.delete(place, True)
    return len(gone)
