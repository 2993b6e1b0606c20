"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

#: Rows that go to a Python worker at once: a MB or two of texts.
ARROW_ROWS = "400"
#: Bytes that go to a Python worker at once, where rows are large.
ARROW_BYTES = "4m"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The ASCII white space [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, where they start from another
    folder and find it neither installed nor on PYTHONPATH: Spark sends it to
    them as a zip (a few files, from the driver's own temporary folder)."""
    package, app = Path(__file__).resolve().parents[1], spark.sparkContext.applicationId
    root = str(package.parent)
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if app in _SHIPPED or "site-packages" in root or root in map(os.path.realpath, known):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared ``spark.checkpoint.dir`` and read it
    back: its lineage is cut, and a lost executor loses nothing of it."""
    path = work_dir(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batched(df: DataFrame) -> DataFrame:
    """``df``, to be handed to Python in batches of ARROW_ROWS or ARROW_BYTES."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def hash128(text: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes of a string."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)
