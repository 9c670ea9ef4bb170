"""Small fixtures and readers shared by the tests."""

from datetime import datetime

from docledger.schemas import FAILURE, FAILURE_DETAILS, MANIFEST, OUTCOME, SUCCESS

T0 = datetime(2024, 1, 1)
T1 = datetime(2024, 2, 1)


def manifest(spark, *keys, root="\\\\srv\\share", folder="in"):
    rows = [(a, d, "AR1", root, folder, f"{d}.pdf") for a, d in keys]
    return spark.createDataFrame(rows, MANIFEST)


def success(spark, *keys, path="p", at=T0, run="run-0"):
    return spark.createDataFrame(
        [(a, d, run, path, "t", 5, at, at, "AR1") for a, d in keys], SUCCESS)


def failure(spark, *rows, at=T0, run="run-0", code=503, message="old"):
    """Rows are (auth, doc, retry_count, flag)."""
    return spark.createDataFrame(
        [(a, d, run, n, f"path-{d}", flag, message, code, at, at, "AR1") for a, d, n, flag in rows],
        FAILURE)


def details(spark, *rows, at=T0):
    """Rows are (auth, doc, run)."""
    return spark.createDataFrame(
        [(a, d, run, 503, "old", at, at, "AR1") for a, d, run in rows], FAILURE_DETAILS)


def outcomes(spark, *rows, run="run-1", at=T1):
    """Rows are (auth, doc, code): 200 is a success."""
    return spark.createDataFrame([
        (a, d, "AR1", f"path-{d}", run, code == 200, None if code == 200 else code,
         None if code == 200 else f"code {code}", f"t/{d}" if code == 200 else None,
         10 if code == 200 else None, None, 1, 7, at, at) for a, d, code in rows], OUTCOME)


def rows(df, *columns):
    """Values of the columns, sorted; NULL sorts as text."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def final_plan(df):
    """The physical plan after adaptive execution has run it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()
