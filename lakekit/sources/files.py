"""File catalogue: search, lookup, owners, folders and export planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions import fixed_values as fixed


def search(files: DataFrame, predicate: str | Column) -> DataFrame:
    """Files that meet the caller's predicate and are not in the trash."""
    return files.where(predicate).where("NOT trashed")


def lookup(files: DataFrame, file_id: str) -> DataFrame:
    return files.where(F.col("id") == file_id)


def is_folder(mime_type: Column) -> Column:
    return F.coalesce(mime_type == fixed.FOLDER_MIME, F.lit(False))


def owner_emails(owners: Column) -> Column:
    """E-mail addresses of an owner array, owners without one left out."""
    return F.transform(F.filter(owners, lambda o: o["email"].isNotNull()), lambda o: o["email"])


def export_formats(spark: SparkSession) -> DataFrame:
    """The export dimension: 17 fixed rows."""
    return spark.createDataFrame(
        list(fixed.EXPORT_FORMATS), "source_mime STRING, target STRING, export_mime STRING, extension STRING")


def export_plan(files: DataFrame, mime: str = "mime_type", target: str = "target", name: str = "name") -> DataFrame:
    """Add export_mime, output_name and is_valid for each file's requested target.

    The dimension has a fixed 17 rows, so broadcasting it is safe at any scale.
    """
    formats = F.broadcast(export_formats(files.sparkSession).withColumnRenamed("target", "_target"))
    hit = (F.col(mime) == F.col("source_mime")) & (F.col(target) == F.col("_target"))
    return files.join(formats, hit, "left").select(
        *files.columns, "export_mime",
        F.concat(F.col(name), F.lit("."), F.col("extension")).alias("output_name"),
        F.col("extension").isNotNull().alias("is_valid"))
