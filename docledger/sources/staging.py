"""Results written once to the shared folder, and the look-ups that takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def is_complete(spark: SparkSession, folder: str) -> bool:
    """True for a folder a Spark write has finished."""
    fs, marker = file_system(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back, so that later actions do not repeat the work behind ``df``.

    A finished folder is reused: a re-run of the same batch does not repeat it either.
    """
    spark = df.sparkSession
    if not is_complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write anew and read back: for rows that are read more than once, but must not outlast what they come from."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
