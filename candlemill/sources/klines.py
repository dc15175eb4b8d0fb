"""Raw candle files: headerless positional CSV, one logical file per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.operators.clean import bronze_rows
from candlemill.schema import DOUBLE_COLUMNS, LINEAGE_COLUMNS, RAW_COLUMNS, RAW_SCHEMA

# SYMBOL-INTERVAL-YYYY-MM.csv
NAME_PATTERN = r"[A-Za-z0-9]+-\d+[A-Za-z]+-\d{4}-\d{2}\.csv"

# A cell that does not parse is NULL and leaves the rest of its line alone;
# short lines are padded, extra cells dropped.
CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def _matched(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, NAME_PATTERN, 0), F.lit(""))


def with_lineage(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add symbol and period from the file name; NULL when it does not match."""
    matched = df.withColumn("_matched", _matched(F.col(name)))

    def part(place: int) -> Column:
        return F.split_part("_matched", F.lit("-"), F.lit(place))

    year, month = part(3), F.substring(part(4), 1, 2)
    return matched.withColumns(
        {
            "symbol": part(1),
            "file_period": F.concat(year, F.lit("-"), month),
            "file_year": year.try_cast("int"),
            "file_month": month.try_cast("int"),
        }
    ).drop("_matched")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every CSV file under ``path`` with their source file.

    A folder named like a monthly file counts as that file, so a month may be
    split into parts. A folder without any CSV file is an error.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(path)
    )
    if found.select("path").isEmpty():
        raise FileNotFoundError(f"no CSV file in {path}")
    raw = (
        spark.read.schema(RAW_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    name = F.coalesce(_matched(F.col("_metadata.file_path")), F.col("_metadata.file_name"))
    return raw.select(*RAW_COLUMNS, name.alias("source_file"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Rows from CSV ``line`` values; ``member`` names their file."""
    cells = F.from_csv("line", RAW_SCHEMA.toDDL(), CSV_OPTIONS)
    return lines.select(cells.alias("_cells"), F.col("member").alias("source_file")).select(
        *[F.col(f"_cells.{c}") for c in RAW_COLUMNS], "source_file"
    )


def to_bronze(raw: DataFrame) -> DataFrame:
    """Typed rows with lineage; rows without times or prices are left out.

    NaN cells count as missing.
    """
    none = F.lit(None).cast("double")
    known = raw.withColumns({c: F.nanvl(F.col(c), none) for c in DOUBLE_COLUMNS})
    rows = with_lineage(bronze_rows(known))
    return rows.select("symbol", *RAW_COLUMNS, *LINEAGE_COLUMNS)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return to_bronze(read_raw(spark, path))
