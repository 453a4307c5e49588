"""Source table: scans, the CSV form of a sale, and full replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.contract import SALES_SCHEMA, SALES_TEXT_SCHEMA, SOURCE_COLUMNS
from saleskeep.sources.split_csv import BLOCK, FILE, PLACE, read_split_csv
from saleskeep.workspace import PACKED, Workspace

# Rows per written file: keeps every file small enough for one task to read.
ROWS_PER_FILE = 1_000_000


def scan_sales(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The seven source columns of a parquet table; ``ordered`` sorts by sale id."""
    sales = spark.read.parquet(path).select(*SOURCE_COLUMNS)
    return sales.orderBy("id_venta") if ordered else sales


def jdbc_options(
    url: str,
    table: str,
    lowest_id: int,
    highest_id: int,
    partitions: int,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options for a parallel scan in ranges of the sale id.

    The bounds only place the cuts: rows outside them are read by the outer ranges.
    """
    return {
        "url": url,
        "dbtable": f"(SELECT {', '.join(SOURCE_COLUMNS)} FROM {table}) AS sales",
        "partitionColumn": "id_venta",
        "lowerBound": str(lowest_id),
        "upperBound": str(highest_id),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def scan_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def replace_jdbc(sales: DataFrame, url: str, table: str, batch_rows: int = 10_000) -> None:
    """Truncate a database table and load it again, keeping its definition."""
    writer = sales.select(*SOURCE_COLUMNS).write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=table, truncate="true", batchsize=str(batch_rows)).save()


def as_text(sales: DataFrame) -> DataFrame:
    """The seven columns as written to CSV: ISO dates, two-decimal prices."""
    kinds = dict(sales.dtypes)

    def text(name: str) -> Column:
        column = F.col(name)
        if name == "precio_unitario" and kinds[name] != "string":
            column = column.cast("decimal(38,2)")
        elif name == "fecha_venta" and kinds[name] != "string":
            column = column.cast("date")
        return column.cast("string").alias(name)

    return sales.select(*map(text, SOURCE_COLUMNS))


def write_csv(
    sales: DataFrame, path: str, mode: str = "errorifexists", packing: dict[str, str] | None = None
) -> None:
    """Write sales as UTF-8 CSV with a header, NULL and blank both as an empty field; ``packing`` holds
    further options of the writer.

    Inner quotes are doubled and outer spaces kept, so reading gives back the same text.
    """
    (
        as_text(sales)
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .options(**(packing or {}))
        .csv(path)
    )


#: Where a row was read.
POSITION = (FILE, BLOCK, PLACE)


def read_csv(
    spark: SparkSession, path: str, multi_line: bool = True, positions: bool = False
) -> DataFrame:
    """Read sales CSV as text: blank fields as empty text, header lines dropped. `positions` adds
    the columns POSITION.

    A row with too few or too many fields fails the read. ``multi_line`` allows line breaks
    inside quoted fields and reads each file in one task, which suits files of bounded size like
    those that `write_csv` makes; `read_split_csv` reads others.
    """
    rows = (
        spark.read.schema(SALES_TEXT_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(path)
    )
    if positions:
        rows = rows.withColumns({
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_place": F.monotonically_increasing_id(),
        })
    filled = rows.fillna("", list(SOURCE_COLUMNS))
    return filled.filter(F.col("id_venta") != "id_venta")


def replace_source(spark: SparkSession, csv_path: str, table_path: str) -> int:
    """Replace the source table with the rows of a CSV of any origin; returns the rows loaded.

    Text that does not fit its column type fails the load and an empty field is NULL.
    """
    workspace = Workspace(spark, options=PACKED)
    text = read_split_csv(spark, csv_path, workspace)
    typed = text.select(
        *(
            F.nullif(F.col(field.name), F.lit("")).cast(field.dataType).alias(field.name)
            for field in SALES_SCHEMA.fields
        )
    )
    typed.write.mode("overwrite").parquet(table_path)
    workspace.drop()
    return spark.read.schema(SALES_SCHEMA).parquet(table_path).count()
