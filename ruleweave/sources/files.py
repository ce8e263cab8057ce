"""Comment, prediction and submission files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.defaults import EXAMPLE_COLUMNS
from ruleweave.functions.text import clean_urls, normalize_missing

TEST_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("body", "rule", "subreddit", *EXAMPLE_COLUMNS)]
)
TRAIN_SCHEMA = T.StructType([*TEST_SCHEMA.fields, T.StructField("rule_violation", T.IntegerType())])
PREDICTION_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType()), T.StructField("rule_violation", T.DoubleType())]
)


def _typed(name: str, kind: T.DataType) -> Column:
    text = normalize_missing(F.col(f"`{name}`"))
    if isinstance(kind, (T.LongType, T.IntegerType)):
        # Whole numbers may be written as 1.0. A fraction, or what is not a number, is an error.
        number = text.cast("double")
        problem = F.raise_error(F.concat(F.lit(f"not a whole number in {name}: "), text))
        whole = F.when(number == F.floor(number), number.cast(kind)).otherwise(problem.cast(kind))
        return F.when(text.isNull(), F.lit(None).cast(kind)).otherwise(F.coalesce(text.try_cast(kind), whole)).alias(name)
    return text.cast(kind).alias(name)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    # Cells come as text under the names in the header, so the column order is free. It is the same for all files of a
    # folder: Spark maps cells by position, so a file with another header is refused.
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"'}
    header = spark.read.csv(path, **options).columns
    names = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.csv(path, schema=names, enforceSchema=False, **options)
    return raw.select(*[_typed(f.name, f.dataType) for f in schema.fields])


def scan_comments(
    spark: SparkSession,
    path: str,
    *,
    labelled: bool = False,
    file_format: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Train or test comments with a fixed schema; missing-value tokens become null.

    A CSV file whose fields hold line breaks cannot be split, so one file is one task: keep such files small, set
    ``multi_line=False`` if no field holds a line break, or use Parquet for large tables.
    """
    schema = TRAIN_SCHEMA if labelled else TEST_SCHEMA
    if file_format == "csv":
        return _read_csv(spark, path, schema, multi_line)
    raw = spark.read.format(file_format).load(path)

    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.StringType):
            return normalize_missing(field.name).alias(field.name)
        return F.col(field.name).cast(field.dataType)

    return raw.select(*[column(f) for f in schema.fields])


# Rows of a file, which one task reads whole if its fields may hold line breaks.
ROWS_PER_FILE = 2_000


def write_comments(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    rows_per_file: int = ROWS_PER_FILE,
    codec: str | None = None,
) -> None:
    """Write a comment table as a folder of CSV files that ``scan_comments`` reads; missing cells are left empty.

    A task starts another file after ``rows_per_file`` rows, so that the size of a file does not grow with the table.
    ``codec`` compresses the files, for instance ``gzip``; by its ending a file tells readers how. The fast level of gzip takes a
    sixth of the time of the default one, and a tenth more room.
    """
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("zlib.compress.level", "BEST_SPEED").csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=codec
    )


def load_clean(df: DataFrame, *, text_col: str = "body") -> DataFrame:
    """Comments with URLs cleaned in their text; a missing text stays missing."""
    return df.withColumn(text_col, clean_urls(text_col))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, PREDICTION_SCHEMA, multi_line=False)


def read_predictions_pair(spark: SparkSession, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """Two prediction files. Spark raises an error about the path if either is missing."""
    return read_predictions(spark, first), read_predictions(spark, second)


def submission_columns(df: DataFrame) -> DataFrame:
    return df.select("row_id", "rule_violation")


def write_submission(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Write ``row_id, rule_violation`` as a folder of CSV files with headers, one per partition."""
    submission_columns(df).write.mode(mode).csv(path, header=True)
