"""Batch audit: control rows, reconciliation, manifests and content digests."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import MAX_EMAX, MIN_EMIN, ROUND_HALF_EVEN, Context, Decimal
from hashlib import sha256
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.contract import CONTROL_SCHEMA, SCHEMA_VERSION, SOURCE_COLUMNS, SOURCE_SYSTEM
from saleskeep.functions.clock import batch_instant
from saleskeep.functions.parse import NUMBER

MONEY = "decimal(38,2)"


class ReconciliationError(RuntimeError):
    """A batch whose counts do not agree."""


def batch_summary(evaluated: DataFrame) -> DataFrame:
    """Counts, start and raw amount per batch, over every row whatever its verdict."""
    valid = F.col("es_valido")
    return evaluated.groupBy("batch_id").agg(
        F.min("ingestion_timestamp").alias("fecha_inicio"),
        F.count("*").alias("registros_origen"),
        F.count_if(valid).alias("registros_validos"),
        F.count_if(~valid).alias("registros_rechazados"),
        F.coalesce(F.sum("importe_fila"), F.lit(0)).cast(MONEY).alias("importe_origen"),
        F.count_if(valid & ~F.col("id_usual")).alias("unusual_ids"),
        F.min(F.when(valid, F.col("id_venta"))).alias("lowest_id"),
        F.max(F.when(valid, F.col("id_venta"))).alias("highest_id"),
    )


def publication_summary(fact: DataFrame) -> DataFrame:
    """Published rows and amount per batch."""
    return fact.groupBy("batch_id").agg(
        F.count("*").alias("registros_publicados"),
        F.sum("total_venta").cast(MONEY).alias("importe_publicado"),
        F.max("venta_key").alias("ultima_venta_key"),
        F.min("id_venta").alias("id_minimo"),
        F.max("id_venta").alias("id_maximo"),
    )


def batch_control(summary: DataFrame, fact: DataFrame, finished_at: Column) -> DataFrame:
    """Control row of each batch: SUCCESS only when every valid row was published.

    Added columns hold the valid rows that earlier batches had published already, the largest
    fact key of the batch, and the range of sale ids it published.
    """
    both = summary.join(publication_summary(fact), "batch_id", "left")
    published = F.coalesce("registros_publicados", F.lit(0)).cast("bigint")
    complete = F.col("registros_validos") == published
    columns = {
        "fecha_fin": finished_at,
        "registros_publicados": published,
        "importe_publicado": F.coalesce("importe_publicado", F.lit(0)).cast(MONEY),
        "estado": F.when(complete, "SUCCESS").otherwise("FAILED"),
        "registros_ya_publicados": F.col("registros_validos") - published,
    }
    return both.select(
        *(columns.get(name, F.col(name)).alias(name) for name in CONTROL_SCHEMA.names)
    )


def reconciliation(control: DataFrame, extracted: DataFrame) -> DataFrame:
    """Reconciliation checks per extracted batch; ``extracted`` is (batch_id, extracted_count).

    ``outcome`` is the first check that failed, in the order they are made, or RECONCILED.
    """
    row = extracted.join(control, "batch_id", "left")
    source_matches = F.col("registros_origen") == F.col("extracted_count")
    split_matches = (
        F.col("registros_validos") + F.col("registros_rechazados") == F.col("registros_origen")
    )
    fully_published = (F.col("registros_validos") == F.col("registros_publicados")) & (
        F.col("estado") == "SUCCESS"
    )
    outcome = (
        F.when(F.col("registros_origen").isNull(), "NO CONTROL ROW")
        .when(~source_matches, "SOURCE COUNT DIFFERS")
        .when(~split_matches, "VALID AND REJECTED DIFFER FROM SOURCE")
        .when(~fully_published, "WAREHOUSE NOT FULLY PUBLISHED")
        .otherwise("RECONCILED")
    )
    return row.select(
        "batch_id",
        "extracted_count",
        F.col("registros_origen").alias("source_count"),
        F.col("registros_validos").alias("valid_count"),
        F.col("registros_rechazados").alias("rejected_count"),
        F.col("registros_publicados").alias("published_count"),
        F.col("importe_publicado").alias("published_amount"),
        F.col("estado").alias("status"),
        outcome.alias("outcome"),
    )


def require_reconciled(checked: DataFrame) -> dict[str, Any]:
    """The six reconciled figures of a one-batch reconciliation; raises on a failed check."""
    row = checked.first()
    if row.outcome != "RECONCILED":
        details = {name: value for name, value in row.asDict().items() if value is not None}
        raise ReconciliationError(f"{row.outcome}: {details}")
    figures = (
        "source_count", "valid_count", "rejected_count", "published_count",
        "published_amount", "status",
    )
    return {name: row[name] for name in figures}


def operations(control: DataFrame) -> DataFrame:
    """Operations page: per batch the share of valid rows and the amounts side by side."""
    source = F.col("registros_origen")
    quality = F.try_divide(F.col("registros_validos") * 100.0, source)
    return control.select(
        "batch_id",
        "estado",
        "registros_origen",
        "registros_validos",
        "registros_rechazados",
        "registros_publicados",
        F.round(quality, 6).alias("calidad_pct"),
        "importe_origen",
        "importe_publicado",
        (F.col("importe_origen") - F.col("importe_publicado")).cast(MONEY).alias("diferencia"),
    )


def content_digest(rows: DataFrame) -> DataFrame:
    """Row count and SHA-256 digest of a table's content: one row (record_count, sha256).

    Each row is hashed as text and the first 120 bits of the hashes are added up in six
    pieces, so neither row order nor file layout matters, every row and its repetition does,
    and nothing is gathered in one place. A NULL differs from an empty text.
    """
    hashed = with_row_hash(rows, rows.columns)
    return hashed.agg(F.count("*").alias("record_count"), combined_hash().alias("sha256"))


def files_digest(spark: SparkSession, path: str) -> DataFrame:
    """File count, bytes and SHA-256 of a folder's files as they lie in storage: one row (n_files,
    n_bytes, sha256).

    A tree of hashes: each file is hashed where it is read; files are dealt by a hash of their
    name to 4,096 nodes, each of which hashes the names, lengths and hashes of its files in
    order; the root hashes the nodes in order. So a changed byte, a renamed, missing or added file
    gives another digest. A file is read whole by its task, so none may exceed 2 GB; what is
    landed has a bounded number of rows a file. Empty files, markers and other hidden files don't count.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.substring_index("path", "/", -1)
    leaf = F.concat_ws(" ", name, F.col("length").cast("string"), F.sha2("content", 256))
    node = F.substring(F.sha2(name, 256), 1, 3)
    leaves = files.select(node.alias("node"), leaf.alias("leaf"), "length")
    nodes = leaves.groupBy("node").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("leaf")), "\n"), 256).alias("hash"),
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
    )
    line = F.concat_ws(" ", "node", "hash")
    return nodes.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("n_bytes"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("sha256"),
    )


def with_row_hash(rows: DataFrame, columns: Sequence[str], *kept: Column) -> DataFrame:
    """The first 120 bits of the SHA-256 of each row as text, in two numbers."""
    cells = [
        F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("~"))
        for name in columns
    ]
    hashed = rows.select(F.sha2(F.concat_ws("\x1f", *cells), 256).alias("_hash"), *kept)
    halves = {
        f"_hash_{at}": F.conv(F.substring("_hash", at, 15), 16, 10).cast("bigint")
        for at in (1, 16)
    }
    return hashed.withColumns(halves).drop("_hash")


def _hash_pieces() -> list[Column]:
    return [
        F.sum(F.shiftright(half, bits).bitwiseAND(F.lit((1 << 20) - 1)))
        for half in ("_hash_1", "_hash_16")
        for bits in (0, 20, 40)
    ]


def combined_hash() -> Column:
    """Aggregate of the row hashes; pieces of 20 bits add up without overflow to 2^43 rows."""
    parts = (F.coalesce(piece.cast("string"), F.lit("0")) for piece in _hash_pieces())
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), *parts), 256)


# Digits of a limb, and the powers of ten that decimal arithmetic reaches.
LIMB, REACH = 9, 1_000_000


def _with_limbs(rows: DataFrame, name: str) -> DataFrame:
    """`rows` with a number as limbs of LIMB digits, lowest first, and the place of the lowest one:
    limb i counts 10^(LIMB * (place + i)). NULL for what is no number, or out of reach.

    Each step is a column of its own, so that none is computed twice."""
    of = f"_{name}_{{}}".format
    text = F.replace(name, F.lit("_"), F.lit(""))
    digits, short, power = (F.col(of(x)) for x in ("digits", "short", "power"))
    parts = {of(part): F.regexp_extract(of("text"), NUMBER, n) for n, part in enumerate(("sign", "before", "after", "exponent"), 1)}
    rows = rows.withColumn(of("text"), F.when(text.rlike(NUMBER), text)).withColumns(parts)
    rows = rows.withColumn(of("digits"), F.ltrim(F.concat(of("before"), of("after")), F.lit("0")))
    rows = rows.withColumns({
        of("short"): F.rtrim(digits, F.lit("0")),
        of("raised"): F.when(F.col(of("exponent")) == "", F.lit(0).cast("bigint")).otherwise(F.col(of("exponent")).try_cast("bigint")),
    })
    fits = (short == "") | F.coalesce(F.col(of("raised")).between(-REACH, REACH), F.lit(False))
    moved = F.col(of("raised")) + F.length(digits) - F.length(short) - F.length(of("after"))
    rows = rows.withColumn(of("power"), F.when(short == "", F.lit(0)).when(fits, moved))
    rows = rows.withColumn(of("place"), F.floor(power / LIMB))
    shifted = F.concat(short, F.repeat(F.lit("0"), (power - F.col(of("place")) * LIMB).cast("int")))
    rows = rows.withColumn(of("shifted"), shifted)
    count = F.greatest(F.lit(1), F.ceil(F.length(of("shifted")) / LIMB)).cast("int")
    rows = rows.withColumn(of("count"), count)
    rows = rows.withColumn(of("padded"), F.lpad(F.col(of("shifted")), F.col(of("count")) * LIMB, F.lit("0")))
    start = lambda n: (F.col(of("count")) - n) * LIMB + 1
    limbs = F.transform(
        F.sequence(F.lit(1), F.col(of("count"))),
        lambda n: F.substr(F.col(of("padded")), start(n), F.lit(LIMB)).cast("bigint") * F.when(F.col(of("sign")) == "-", -1).otherwise(1),
    )
    return rows.withColumn(of("limbs"), F.when(F.col(of("power")).isNotNull(), limbs))


# Quantities and prices as they mostly are: whose product any decimal type holds.
PLAIN_QUANTITY, PLAIN_PRICE = r"^[0-9]{1,9}\z", r"^[0-9]{1,9}(?:\.[0-9]{1,2})?\z"


def _products(landed: DataFrame) -> DataFrame:
    """The rows' hashes and quantity times price: `_plain` where both are plain numbers; elsewhere
    `_amount`, (place, value) of its limbs, NULL where either is no number."""
    names = ("cantidad", "precio_unitario")
    plain = F.col("cantidad").rlike(PLAIN_QUANTITY) & F.col("precio_unitario").rlike(PLAIN_PRICE)
    rows = with_row_hash(landed, SOURCE_COLUMNS, *(F.col(n) for n in names), plain.alias("_is_plain"))
    product = F.col("cantidad").try_cast("decimal(9,0)") * F.col("precio_unitario").try_cast("decimal(11,2)")
    rows = rows.withColumn("_plain", F.when(F.col("_is_plain"), product).cast("decimal(28,2)"))
    rows = rows.withColumns({n: F.when(F.col("_is_plain"), None).otherwise(F.col(n)) for n in names})
    for name in names:
        rows = _with_limbs(rows, name)
    place = F.col("_cantidad_place") + F.col("_precio_unitario_place")
    pairs = F.flatten(F.transform(
        "_cantidad_limbs",
        lambda x, i: F.transform(
            "_precio_unitario_limbs",
            lambda y, j: F.struct((place + i + j).alias("place"), (x * y).alias("value")),
        ),
    ))
    return rows.select("_hash_1", "_hash_16", "_plain", pairs.alias("_amount"))


def landed_figures(landed: DataFrame) -> tuple[int, Decimal, str]:
    """Rows, the exact sum of quantity times price, and the digest of a landed batch, in one pass.

    Numbers may have any number of digits; underscores between them don't count. What is no
    number, or has an exponent beyond a million, adds nothing. Products of
    plain numbers are added up as decimals, others as limbs per place, so there is a row per place
    here, and these are put together.
    """
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    parts = _products(landed).select("_hash_1", "_hash_16", "_plain", F.posexplode_outer("_amount").alias("_at", "_limb"))
    counted = F.when(first, F.col("_hash_1")), F.when(first, F.col("_hash_16"))
    found = parts.select(
        F.col("_limb.place").alias("place"), F.col("_limb.value").alias("value"), first.alias("first"),
        counted[0].alias("_hash_1"), counted[1].alias("_hash_16"), "_plain",
    ).groupBy("place").agg(
        F.sum("_plain").alias("plain"),
        F.sum(F.col("value").cast("decimal(20,0)")).alias("value"), F.count_if("first").alias("rows"),
        *(piece.alias(f"piece_{n}") for n, piece in enumerate(_hash_pieces())),
    ).collect()
    count = sum(r.rows for r in found)
    pieces = (str(sum(r[f"piece_{n}"] or 0 for r in found)) for n in range(6))
    digest = sha256(":".join([str(count), *pieces]).encode()).hexdigest()
    sums = {r.place: int(r.value) for r in found if r.place is not None}
    for cents in (int(r.plain.scaleb(2)) for r in found if r.plain is not None):
        sums[-1] = sums.get(-1, 0) + cents * 10 ** (LIMB - 2)
    return count, _total(sums), digest


def _total(sums: dict[int, int]) -> Decimal:
    """The sum of all limbs, exact."""
    digits = (max(sums, default=0) - min(sums, default=0) + 8) * LIMB
    wide = Context(prec=max(digits, 64), rounding=ROUND_HALF_EVEN, Emax=MAX_EMAX, Emin=MIN_EMIN)
    total = Decimal(0)
    for place in sorted(sums, reverse=True):
        total = wide.add(total, wide.scaleb(Decimal(sums[place]), place * LIMB))
    return total


def manifest(
    landed: DataFrame,
    batch_id: str,
    extracted_at: Column,
    file_name: str = "ventas_origen.csv",
    schema_version: str = SCHEMA_VERSION,
    source_system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """One-row manifest of a landed batch: every row counts, unreadable amounts add nothing and
    readable ones are added up whatever their size and decimals.

    The extraction time is the one the batch id names, or ``extracted_at``.
    """
    count, total, digest = landed_figures(landed)
    digits = max(64, total.adjusted() + 64)
    cents = Context(prec=digits, rounding=ROUND_HALF_EVEN, Emax=MAX_EMAX, Emin=MIN_EMIN).quantize(total, Decimal("0.01"))
    instant = F.coalesce(batch_instant(F.lit(batch_id)), extracted_at).cast("string")
    return landed.sparkSession.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source_system).alias("source_system"),
        F.lit(schema_version).alias("schema_version"),
        F.concat(F.replace(instant, F.lit(" "), F.lit("T")), F.lit("+00:00")).alias(
            "extracted_at_utc"
        ),
        F.lit(file_name).alias("file_name"),
        F.lit(count).cast("bigint").alias("record_count"),
        F.lit(f"{cents:f}").alias("total_amount"),
        F.lit(digest).alias("sha256"),
    )
