"""CSV and Parquet scans and the Parquet sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spanlake import names as n
from spanlake.functions.amounts import quoted

# Dialect of the input files.
CSV_DIALECT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = False,
    corrupt_column: str | None = None,
    check_header: bool = False,
) -> DataFrame:
    """CSV files under an explicit schema; columns are bound by position.

    Values that do not fit become NULL and the row is kept.  ``corrupt_column`` adds the text of
    such records.  ``multi_line`` reads quoted line breaks, at the price of one task per file.
    ``check_header`` fails on a header that differs from the schema.
    """
    options = dict(
        CSV_DIALECT,
        multiLine=str(multi_line).lower(),
        enforceSchema=str(not check_header).lower(),
    )
    if corrupt_column is not None:
        schema = StructType([*schema.fields]).add(corrupt_column, StringType())
        options["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.options(**options).schema(schema).csv(path)


BAD_CELLS = "_bad_cells"


def read_csv_cells(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, bad: str = BAD_CELLS
) -> DataFrame:
    """CSV files under an explicit schema, with the cells that do not fit it.

    All fields are read as text and cast one by one.  A cell whose text is no value of its type is NULL,
    and ``bad`` has its ``field`` and ``text``, in the order of the fields; the other cells of the row are kept.  A
    blank cell is NULL and not bad.  Every row is kept, also one with too few fields.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = read_csv(spark, path, texts, multi_line)
    cells, wrong = [], []
    for f in schema.fields:
        text = F.col(quoted(f.name))
        value = text if isinstance(f.dataType, StringType) else text.try_cast(f.dataType)
        cells.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            failed = F.struct(F.lit(f.name).alias("field"), text.alias("text"))
            wrong.append(F.when((F.trim(text) != "") & value.isNull(), failed))
    none = F.array().cast("array<struct<field:string,text:string>>")
    found = F.array_compact(F.array(*wrong)) if wrong else none
    return raw.select(*cells, found.alias(bad))


def quarantine(df: DataFrame, bad: str = BAD_CELLS) -> tuple[DataFrame, DataFrame]:
    """Rows all of whose cells fit, without the column ``bad``, and the others with it."""
    return df.where(F.size(bad) == 0).drop(bad), df.where(F.size(bad) > 0)


def with_load_columns(df: DataFrame, source_file: str, layer: str = "BRONZE") -> DataFrame:
    """Add file name, load time and layer."""
    return df.withColumns(
        {
            n.SOURCE_FILE: F.lit(source_file),
            n.LOAD_TIME: F.current_timestamp(),
            n.LAYER: F.lit(layer),
        }
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite the table and return it as read back from storage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows; a Parquet scan answers it from the footers."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def write_observed(df: DataFrame, path: str) -> tuple[int, int]:
    """Overwrite the table; returns the rows sent to the writer and the rows found afterwards.

    The first number is observed during the write, so the source is scanned once.
    """
    sent = Observation()
    written = write_table(df.observe(sent, F.count(F.lit(1)).alias("rows")), path)
    return sent.get["rows"], written.count()
