"""The sales model over the given tables, with faults that every quality rule meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.sources.sales import as_text

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files, combined without listing them here."""
    paths = [f"{sf_dir}/{name}.parquet" for name in TABLES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    marks = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count("*"), F.sum("length"), F.sum(marks)).first())


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order line; sale ids repeat where the lines of an order do."""
    regions = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_orderdate", "r_name")
    )
    lines = table(spark, sf_dir, "lineitem").join(
        regions, F.col("l_orderkey") == F.col("o_orderkey")
    )
    priced = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return priced.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_venta"),
        F.col("o_orderdate").cast("date").alias("fecha_venta"),
        product_name().alias("producto"),
        F.col("p_type").alias("categoria"),
        F.col("r_name").alias("region"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("precio_unitario"),
    )


def product_name() -> Column:
    return F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        product_name().alias("producto"),
        F.col("p_type").alias("categoria"),
        F.lit(True).alias("activo"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(F.col("r_name").alias("region"), F.lit(True).alias("activo"))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a user of their own region, inactive when in debt."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("usuario_correo"),
            F.col("r_name").alias("region"),
            (F.col("c_acctbal") >= 0).alias("activo"),
        )
    )


def faulty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale as text, regions in lower case, with faults by the last digits of the id.

    All sales stay; out of every thousand ids some get one field changed. Line numbers run from
    1 to 7, so only ids with such a last digit occur.
    """
    text = as_text(sales(spark, sf_dir)).withColumn(
        "_case", F.col("id_venta").cast("bigint") % 1000
    )
    other_category = F.when(F.col("categoria") == "SMALL", "LARGE").otherwise("SMALL")

    def changed(name: str, otherwise: Column, **cases: Column) -> Column:
        value = otherwise
        for case, replacement in cases.items():
            value = F.when(F.col("_case") == int(case[1:]), replacement).otherwise(value)
        return value.alias(name)

    return text.select(
        changed("id_venta", F.col("id_venta"), c24=F.lit(""),
                c16=F.concat(F.lit("A"), "id_venta"), c17=F.concat(F.lit(" "), "id_venta")),
        changed("fecha_venta", F.col("fecha_venta"), c1=F.lit("2026-02-30"),
                c2=F.lit("2026-09-02"), c26=F.translate("fecha_venta", "-", "")),
        changed("producto", F.col("producto"), c3=F.lit(" "), c4=F.upper("producto")),
        changed("categoria", F.col("categoria"), c5=F.lit("UNKNOWN"), c6=other_category,
                c27=F.lit("")),
        changed("region", F.lower("region"), c7=F.lit("nowhere"),
                c31=F.concat(F.lit("\t"), F.lower("region"))),
        changed("cantidad", F.col("cantidad"), c11=F.lit("0"), c12=F.lit("2.5"), c22=F.lit("1e23"), c23=F.lit("25e-1"),
                c25=F.concat(F.lit(" "), "cantidad", F.lit(" ")),
                c32=F.concat(F.lit("\t"), "cantidad")),
        changed("precio_unitario", F.col("precio_unitario"), c13=F.lit("0"), c14=F.lit("x"),
                c15=F.lit("1e2"), c21=F.lit("0.0000000000000000001")),
    )
