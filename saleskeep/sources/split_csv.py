"""CSV files from outside, each read by many tasks, line breaks in quoted fields included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleskeep.contract import SALES_TEXT_SCHEMA, SOURCE_COLUMNS
from saleskeep.workspace import Workspace

# Where a line was read: its file, the block of it, and a number that grows within the block and
# that no other line has.
FILE, BLOCK, PLACE = "_file", "_block", "_place"
# Blocks are cut into parts of this many lines, two to the power: what is put in order at a time.
PART, PART_BITS = "_part", 16
CUT = [FILE, BLOCK, PART]
# The first place of a part, which names it.
FIRST = "_first"

# Quoted text without its closing quote, and whole fields with the comma behind each. A quote
# opens a field only as its first character. Nothing is tried twice, so a line costs its length.
QUOTED = r'(?:[^"]++|"")*+'
FIELDS = rf'(?:(?:"{QUOTED}"|(?!"))[^,]*+,)*+'
#: Lines that end inside a quoted field: those that start outside of one, and inside of one.
OPENS = rf'^{FIELDS}"{QUOTED}\z'
STAYS = rf'^{QUOTED}(?:"[^,]*+,{FIELDS}"{QUOTED})?\z'
#: Blank lines and repeated headers.
NO_SALE = r'^(?:\s*|(?:id_venta|"id_venta")(?:,(?s:.)*)?)\z'


class UnclosedQuoteError(ValueError):
    """A file that ends inside a quoted field."""


def read_split_csv(spark: SparkSession, path: str, workspace: Workspace) -> DataFrame:
    """Read sales CSV of any origin as text, like `read_csv`, but each file in many tasks.

    Files are split into blocks of lines, and these into parts. Each line says whether it ends inside
    a quoted field, for both states it may start in; a part composes its lines and a file its parts,
    one row a part, which tells the state that each part starts in. Parts that start outside of a
    quoted field and in which no line opens one are parsed line by line, without a shuffle. In the
    others lines are put in order part by part, and only those of records with line breaks are
    brought together. The rows that are shuffled name their part by a number, not by its file.

    Lines end with a line feed, with or without a carriage return before it. Blank lines between
    records, the first record of each file and repeated headers are dropped; blank fields are empty
    text. A record with too few or too many fields fails the read, and so does a file that ends
    inside a quoted field. The rows are backed by tables in `workspace`.
    """
    lines = workspace.keep(_lines(spark, path), "lines")
    blocks = workspace.keep(_blocks(lines), "blocks")
    unclosed = blocks.filter("_last AND _ends = 1").select(FILE).first()
    if unclosed:
        raise UnclosedQuoteError(f"{unclosed[0]} ends inside a quoted field")
    placed = lines.join(blocks.select(*CUT, FIRST, "_starts", "_opens", "_header"), CUT)
    # No filter may reach the lines before it is known which of them are whole records, as parsing
    # others fails. So other lines become NULL, by columns that only the joined rows have.
    plain = F.col("_starts") + F.col("_opens") < 1
    simple = placed.select(_value_if(plain & ~F.col("_header").eqNullSafe(F.col(PLACE))))
    mixed = workspace.keep(_records(placed.filter(~plain)), "records")
    records = simple.unionByName(_joined(mixed, blocks)).filter(F.col("value").isNotNull())
    wanted = records.filter(~F.col("value").rlike(NO_SALE))
    fields = F.from_csv(
        F.regexp_replace("value", r"\r\z", ""),
        ", ".join(f"{name} string" for name in SALES_TEXT_SCHEMA.names),
        {"escape": '"', "mode": "FAILFAST", "multiLine": "true"},
    )
    return wanted.select(fields.alias("sale")).select("sale.*").fillna("", list(SOURCE_COLUMNS))


def _value_if(condition: Column) -> Column:
    return F.when(condition, F.col("value")).alias("value")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their position and the states they end in, started outside and inside."""
    text = spark.read.option("lineSep", "\n").text(path)
    numbered = text.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(PLACE),
    )
    return numbered.select(
        "*",
        F.shiftright(PLACE, PART_BITS).alias(PART),
        F.col("value").rlike(OPENS).cast("int").alias("_outside"),
        F.col("value").rlike(STAYS).cast("int").alias("_inside"),
    )


def _composed(steps: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """Adds the composition of all steps up to each one, as `_after` reads it.

    A step keeps the state, turns it, or fixes it. So the state behind a step is the last one fixed,
    or else the first state, turned as often as steps turned it since.
    """
    run = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outside, inside = F.col("_outside"), F.col("_inside")
    turns = F.sum(F.when(outside > inside, 1).otherwise(0)).over(run)
    fixed = F.when(outside == inside, (outside + F.col("_turns")) % 2)
    return steps.withColumn("_turns", turns).withColumn("_fixed", F.last(fixed, True).over(run))


def _after(first: Column) -> Column:
    """The state behind a composed step, given the first state."""
    return ((F.coalesce("_fixed", first) + F.col("_turns")) % 2).cast("int")


def _blocks(lines: DataFrame) -> DataFrame:
    """A row a part: the states it starts and ends in, whether a line of it opens a quoted field,
    and the place of the header, if it is here. Lines are only counted, which tasks do before the
    shuffle: first the last line that fixes the state is found, then the turns behind it."""
    outside, inside = F.col("_outside"), F.col("_inside")
    found = lines.groupBy(*CUT).agg(
        F.min(PLACE).alias(FIRST),
        F.max(outside).alias("_opens"),
        F.max(F.when(outside == inside, F.struct(PLACE, outside))).alias("_last_fixed"),
    )
    turning = lines.filter(outside > inside).join(found.select(*CUT, "_last_fixed"), CUT)
    behind = F.col("_last_fixed").isNull() | (F.col(PLACE) > F.col("_last_fixed")[PLACE])
    turns = turning.filter(behind).groupBy(*CUT).agg(F.count("*").alias("_turns"))
    steps = found.join(turns, CUT, "left").withColumns({
        "_fixed": F.col("_last_fixed._outside"), "_turns": F.coalesce("_turns", F.lit(0)),
    })
    steps = steps.withColumns({"_outside": _after(F.lit(0)), "_inside": _after(F.lit(1))})
    order = Window.partitionBy(FILE).orderBy(BLOCK, PART)
    ends = _composed(steps, [FILE], [BLOCK, PART]).withColumn("_ends", _after(F.lit(0)))
    return ends.select(
        *CUT, FIRST, "_opens", "_ends",
        F.lag("_ends", 1, 0).over(order).alias("_starts"),
        F.when(F.row_number().over(order) == 1, F.col(FIRST)).alias("_header"),
        F.lead(BLOCK).over(order).isNull().alias("_last"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """Lines with `_from`, `_to`, the states before and behind each, and `_start`, the place where its
    record starts in this part; NULL in lines that go on with a record of an earlier part."""
    order = Window.partitionBy(FIRST).orderBy(PLACE)
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    named = lines.select("value", FIRST, BLOCK, PLACE, "_outside", "_inside", "_starts", "_header")
    states = _composed(named, [FIRST], [PLACE]).withColumn("_to", _after(F.col("_starts")))
    states = states.withColumn("_from", F.coalesce(F.lag("_to").over(order), "_starts"))
    here = F.when(F.col("_from") == 0, F.col(PLACE))
    return states.select(
        "value", FIRST, BLOCK, PLACE, "_header", "_from", "_to", F.last(here, True).over(run).alias("_start")
    )


def _joined(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The records of these lines but for headers, those of several lines put together."""
    alone = F.col("_from") + F.col("_to") < 1
    single = lines.select(_value_if(alone & ~F.col("_header").eqNullSafe(F.col(PLACE))))
    before = Window.partitionBy(FILE).orderBy(BLOCK, PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = lines.groupBy(FIRST).agg(F.max("_start").alias("_begun"), F.max("_header").alias("_header"))
    carried = carried.join(blocks.select(*CUT, FIRST), FIRST).select(
        FIRST,
        F.last("_begun", True).over(before).alias("_begun"),
        F.last("_header", True).over(before).alias("_carried_header"),
    )
    parts = lines.filter(~alone).join(carried, FIRST)
    start = F.coalesce("_start", "_begun")
    header = F.coalesce("_header", "_carried_header")
    ordered = F.array_sort(F.collect_list(F.struct(BLOCK, PLACE, "value")))
    whole = (
        parts.withColumns({"_start": start, "_header": header})
        .filter(~F.col("_header").eqNullSafe(F.col("_start")))
        .groupBy("_start")
        .agg(ordered.alias("_parts"))
    )
    return single.unionByName(whole.select(F.array_join("_parts.value", "\n").alias("value")))
