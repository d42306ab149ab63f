"""Files as they arrive: claim files of several layouts, damaged rows, the newest month of a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions import calendar
from panelwright.schema import ALIASES, SERIES_DOCUMENT, normalise_columns
from panelwright.sources import files

#: Column that holds a line or document that does not fit its layout.
MALFORMED = "malformed"


@dataclass(frozen=True)
class Layout:
    """Files that share header, separator and encoding."""

    paths: str | list[str]
    sep: str = ","
    encoding: str = "UTF-8"


def read_layout(spark: SparkSession, layout: Layout) -> DataFrame:
    """Claim rows of one layout as text under their logical names, with `source_file` and `malformed`.

    The header of the first file names the columns; a file with another header fails instead of being read by
    position.  A line with more or fewer fields is kept whole in `malformed`.
    """
    reader = spark.read.option("header", True).option("sep", layout.sep).option("encoding", layout.encoding)
    paths = layout.paths if isinstance(layout.paths, list) else [layout.paths]
    header = reader.csv(paths).schema
    whole = T.StructType([*header.fields, T.StructField(MALFORMED, T.StringType())])
    # without pruning, as a line of too many fields shows only when all of them are read
    strict = reader.schema(whole).option("columnNameOfCorruptRecord", MALFORMED).option("enforceSchema", False).option("columnPruning", False)
    rows = strict.csv(paths).withColumn("source_file", F.col("_metadata.file_name"))
    return normalise_columns(rows, ALIASES | {"source_file": ("source_file",), MALFORMED: (MALFORMED,)}, files.REQUIRED)


def read_layouts(spark: SparkSession, layouts: list[Layout]) -> DataFrame:
    """The rows of all layouts; a column that one lacks is null there."""
    return files.union_years([read_layout(spark, layout) for layout in layouts])


def reject_reason(raw: DataFrame) -> Column:
    """Why a row cannot be counted, null for a good one: `malformed`, or the first column that cannot be read
    (an unreadable or missing date, a count that is no number, a blank key)."""
    readable = {
        "manufacturing_date": calendar.parse_date(F.col("manufacturing_date")).isNotNull(),
        "claim_count": F.trim(F.replace(F.col("claim_count"), F.lit(","), F.lit(""))).try_cast("double").isNotNull(),
    }
    readable |= {c: F.trim(F.coalesce(F.col(c), F.lit(""))) != "" for c in ("plant", "product_cat2", "mid_category")}
    reason = F.when(F.col(MALFORMED).isNotNull(), F.lit(MALFORMED)) if MALFORMED in raw.columns else F.lit(None).cast("string")
    return F.coalesce(reason, *[F.when(~good, F.lit(c)) for c, good in readable.items()])


def accepted(raw: DataFrame) -> DataFrame:
    """Typed claims of the rows that can be read."""
    good = raw.where(reject_reason(raw).isNull())
    return files.typed_claims(good.drop(MALFORMED, "source_file"))


def rejected(raw: DataFrame) -> DataFrame:
    """The rows that `accepted` leaves out, as they came, with their `reason`."""
    return raw.withColumn("reason", reject_reason(raw)).where(F.col("reason").isNotNull())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Series documents in the declared schema; one that does not fit is kept whole in `malformed`."""
    schema = f"{SERIES_DOCUMENT}, {MALFORMED} string"
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).json(path)


def month_stamp(name: Column) -> Column:
    """Year and month in a name (`2024_01`, `202401`, `2024-01-15`, ...) as yyyymm, 0 without one."""
    pattern = r"(?<!\d)(\d{4})[_.-]?(0[1-9]|1[0-2])(?:[_.-]?\d{2})?(?!\d)"
    digits = F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2))
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def newest_month(spark: SparkSession, folder: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """Rows of the files whose name, or whose folder's name directly in `folder`, carries the newest month.

    The month is found on the list of files (a row a file, no content).  It then filters the files by their path, which
    the scan does before it opens any.  `read` turns the folder into a DataFrame of a file source.
    """

    def stamp(path: Column) -> Column:
        return month_stamp(F.element_at(F.split(files.delivery(folder, path), "/"), -1))

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    newest = listed.agg(F.max(stamp(F.col("path"))).alias("m")).first()["m"]
    return read(folder).where(stamp(F.col("_metadata.file_path")) == F.lit(newest))
