"""Reference catalogs: products with their category, and regions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.contract import PRODUCT_CATALOG_SCHEMA, REGION_CATALOG_SCHEMA
from saleskeep.frames import small_frame
from saleskeep.functions.text import catalog_key
from saleskeep.operators.lookup import Lookup

# Product, category, lowest and highest price.
SEED_PRODUCTS = (
    ("Laptop Pro", "Computación", 3200, 5200),
    ("Laptop Business", "Computación", 2400, 3900),
    ("Tablet 10", "Computación", 750, 1500),
    ("Monitor 24", "Computación", 550, 1050),
    ("Smart TV 50", "Electrónica", 1500, 2800),
    ("Smartphone 5G", "Electrónica", 900, 2600),
    ("Audífonos Bluetooth", "Electrónica", 90, 450),
    ("Cámara Digital", "Electrónica", 1200, 3500),
    ("Refrigeradora", "Electrohogar", 1600, 3600),
    ("Microondas", "Electrohogar", 280, 720),
    ("Licuadora", "Electrohogar", 110, 380),
    ("Aspiradora", "Electrohogar", 260, 850),
    ("Impresora Multifuncional", "Oficina", 480, 1300),
    ("Proyector", "Oficina", 950, 2800),
    ("Teclado Inalámbrico", "Oficina", 80, 290),
    ("Mouse Inalámbrico", "Oficina", 45, 180),
    ("Silla Ergonómica", "Muebles", 420, 1250),
    ("Escritorio Ejecutivo", "Muebles", 650, 1800),
    ("Estante Modular", "Muebles", 320, 980),
    ("Archivador", "Muebles", 260, 760),
)
# Regions.
SEED_REGIONS = ("Lima", "Norte", "Sur", "Centro", "Oriente")

PRICED_PRODUCTS = "name string, category string, min_price decimal(12,2), max_price decimal(12,2)"
CATALOG_JSON = f"regions array<string>, products array<struct<{PRICED_PRODUCTS}>>"


def seed_products(spark: SparkSession) -> DataFrame:
    rows = [(name, category, True) for name, category, _, _ in SEED_PRODUCTS]
    return small_frame(spark, rows, PRODUCT_CATALOG_SCHEMA)


def seed_regions(spark: SparkSession) -> DataFrame:
    return small_frame(spark, [(name, True) for name in SEED_REGIONS], REGION_CATALOG_SCHEMA)


def read_catalog_json(
    spark: SparkSession, path: str, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Priced products and regions of a nested catalog document.

    Without ``multi_line`` the document is a file with one part of the catalog on each line.
    """
    document = spark.read.schema(CATALOG_JSON).option("multiLine", multi_line).json(path)
    products = document.select(F.explode("products").alias("p")).select("p.*")
    regions = document.select(F.explode("regions").alias("region"))
    return products, regions


def catalog_checks(
    products: DataFrame, regions: DataFrame, sizes: tuple[int, int, int] | None = None
) -> DataFrame:
    """One row of catalog findings over (name, category, min_price, max_price) and (region).

    ``sizes`` are the agreed numbers of regions, products and categories; without them only
    uniqueness and price ranges decide.
    """
    lowest, highest = F.col("min_price"), F.col("max_price")
    bad_price = lowest.isNull() | highest.isNull() | (lowest <= 0) | (highest < lowest)
    product_facts = products.agg(
        F.count("*").alias("products"),
        F.countDistinct("name").alias("distinct_products"),
        F.countDistinct("category").alias("categories"),
        F.coalesce(F.sum(bad_price.cast("bigint")), F.lit(0)).alias("bad_price_ranges"),
    ).withColumn("_one", F.lit(1))
    region_facts = regions.agg(
        F.count("*").alias("regions"), F.countDistinct("region").alias("distinct_regions")
    ).withColumn("_one", F.lit(1))
    facts = product_facts.join(region_facts, "_one").drop("_one")
    passed = (
        (F.col("regions") == F.col("distinct_regions"))
        & (F.col("products") == F.col("distinct_products"))
        & (F.col("bad_price_ranges") == 0)
    )
    if sizes:
        for column, size in zip(("regions", "products", "categories"), sizes):
            passed &= F.col(column) == size
    return facts.withColumn("passed", passed)


def require_valid_catalog(
    products: DataFrame, regions: DataFrame, sizes: tuple[int, int, int] | None = (5, 20, 5)
) -> None:
    findings = catalog_checks(products, regions, sizes).first()
    if not findings.passed:
        raise ValueError(f"the catalog does not hold what was agreed: {findings.asDict()}")


def categories(products: DataFrame) -> DataFrame:
    return products.select("categoria").distinct()


@dataclass(frozen=True)
class Catalogs:
    """Active catalog entries keyed for the warehouse rules, sizes already counted."""

    products: Lookup
    regions: Lookup
    categories: Lookup

    @classmethod
    def active(cls, products: DataFrame, regions: DataFrame) -> Catalogs:
        """Case-blind catalogs; of several spellings the smallest counts."""
        current = products.filter("activo")
        by_product = current.groupBy(catalog_key(F.col("producto")).alias("_producto")).agg(
            F.min("producto").alias("producto_catalogo"),
            F.min("categoria").alias("categoria_catalogo"),
        )
        by_region = (
            regions.filter("activo")
            .groupBy(catalog_key(F.col("region")).alias("_region"))
            .agg(F.min("region").alias("region_catalogo"))
        )
        known = F.lit(True).alias("categoria_conocida")
        by_category = (
            current.select(catalog_key(F.col("categoria")).alias("_categoria"))
            .distinct()
            .select("_categoria", known)
        )
        return cls._measured(by_product, by_region, by_category, current, regions)

    @classmethod
    def exact(cls, products: DataFrame, regions: DataFrame) -> Catalogs:
        """Case-sensitive catalogs over every entry, as the diagnostic rules use them."""
        by_product = products.groupBy(F.col("producto").alias("_producto")).agg(
            F.max("categoria").alias("categoria_catalogo")
        )
        by_region = (
            regions.select(F.col("region").alias("_region"))
            .distinct()
            .withColumn("region_conocida", F.lit(True))
        )
        by_category = (
            products.select(F.col("categoria").alias("_categoria"))
            .distinct()
            .withColumn("categoria_conocida", F.lit(True))
        )
        return cls._measured(by_product, by_region, by_category, products, regions)

    @classmethod
    def _measured(
        cls,
        by_product: DataFrame,
        by_region: DataFrame,
        by_category: DataFrame,
        products: DataFrame,
        regions: DataFrame,
    ) -> Catalogs:
        # A catalog has no more keys than entries, and no more categories than products. The
        # keyed products hold their name twice.
        entries = products.select("producto", F.col("producto").alias("name"), "categoria")
        product_keys = Lookup.measured(by_product, "_producto", within=entries)
        return cls(
            product_keys,
            Lookup.measured(
                by_region, "_region", within=regions.select("region", F.col("region").alias("r"))
            ),
            Lookup(by_category, "_categoria", True)
            if product_keys.fits
            else Lookup.measured(by_category, "_categoria"),
        )
