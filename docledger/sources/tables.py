"""Plain table reads and writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from docledger.functions.timing import stamped_name
from docledger.schemas import CROSS_REFERENCE, CSV_AUDIT, CSV_MANIFEST


def read_path(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: StructType | None = None) -> DataFrame:
    """A table by path. ``delta`` works wherever the session has that source."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.read.table(name)


# Text stays as it is: blanks at either end, quotes, and line feeds where ``multiline`` is set.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _read_csv(spark: SparkSession, path: str, wanted: StructType, multiline: bool) -> DataFrame:
    names = spark.read.csv(path, multiLine=multiline, **_CSV).columns
    if missing := [name for name in wanted.fieldNames() if name not in names]:
        raise ValueError(f"the header of {path} lacks {missing}")
    found = StructType([StructField(name, StringType()) for name in names])
    # enforceSchema off: every file's own header is compared with the first one.
    rows = spark.read.csv(path, schema=found, enforceSchema=False, multiLine=multiline, **_CSV)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_manifest_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV manifest with a header line, one file or a folder of them with the same header.

    Columns are found by their names, in any order and among others. ``multiline`` allows line
    feeds inside quoted values; such a file is read by one task. Without it files are split.
    """
    return _read_csv(spark, path, CSV_MANIFEST, multiline)


def write_audit_csv(df: DataFrame, folder: str, ts: Column, multiline: bool = True) -> DataFrame:
    """Write the audit rows as CSV with header under a run-stamped folder; returns them re-read.

    The stamp is computed by Spark from ``ts`` so that it agrees with the column expressions.
    """
    spark = df.sparkSession
    name = spark.range(1).select(stamped_name(ts).alias("name")).first()["name"]
    target = f"{folder.rstrip('/')}/{name}.csv"
    df.select(*CSV_AUDIT.fieldNames()).write.csv(target, **_CSV)
    return _read_csv(spark, target, CSV_AUDIT, multiline)


def from_records(spark: SparkSession, rows: Sequence, schema: StructType) -> DataFrame:
    """A few driver-side records as a DataFrame of a fixed schema.

    For the edge of a job only: outcomes of a run never pass through the driver.
    """
    return spark.createDataFrame(list(rows), schema)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def append_once(df: DataFrame, path: str, run_id: str, batch: int = 0) -> None:
    """Append the rows of a run's batch; appending them again replaces them instead of adding copies.

    They get a folder of their own, ``append_run=<run_id>/append_batch=<batch>``, and dynamic partition overwrite touches no
    other. A run that dies after its append and is repeated therefore leaves each row once. Read with
    ``read_appended``, which leaves the two columns out.
    """
    marked = df.withColumns({"append_run": F.lit(run_id), "append_batch": F.lit(batch)})
    (marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("append_run", "append_batch").parquet(path))


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that ``append_once`` has written there."""
    fields = [StructField("append_run", StringType()), StructField("append_batch", IntegerType())]
    return spark.read.schema(StructType(schema.fields + fields)).parquet(path).select(*schema.fieldNames())


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def ensure_tables(spark: SparkSession, specs: Mapping[str, StructType] | None = None, *,
                  database: str = "default", location: str | None = None,
                  renames: Mapping[str, str] | None = None, fmt: str = "parquet") -> list[str]:
    """Create the tables that do not exist yet; running it again changes nothing.

    ``renames`` maps the package's column names to those of an existing lake. ``location`` makes
    the tables external, one folder each.
    """
    names = []
    renamed = dict(renames or {})
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table, schema in (CROSS_REFERENCE if specs is None else specs).items():
        columns = ", ".join(f"`{renamed.get(f.name, f.name)}` {f.dataType.simpleString()}"
                            for f in schema.fields)
        where = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
        name = f"`{database}`.`{table}`"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{where}")
        names.append(name)
    return names


def create_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                    location: str | None = None) -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted by ``keys``.

    A manifest and ledgers bucketed alike are joined without any shuffle. Rows are gathered by
    bucket first, for one file per bucket; the rebalance hint lets a hot bucket be written by
    several tasks.
    """
    gathered = df.hint("rebalance", buckets, *[F.col(k) for k in keys])
    writer = gathered.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.read.table(name)


def audit_rows(df: DataFrame, uploaded_at: Column) -> DataFrame:
    """Successful copies in the columns of the CSV audit."""
    return df.withColumn("uploaded_at", uploaded_at).select(
        *[F.col(c).cast("string").alias(c) for c in CSV_AUDIT.fieldNames()])
