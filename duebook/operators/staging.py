"""Loading, checking and profiling staged transactions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.operators.blocks import dense_key_with_copies
from duebook.schemas import conform

# Longest text per staging column.
TEXT_LIMITS = {
    "invoice_no": 20, "stock_code": 50, "description": 500, "country": 100, "source_file": 200,
}
PRICE_BOUND = 10**8  # unit_price is decimal(10,2)

FACTS = [
    "invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
    "customer_id", "country",
]


def length_rules(limits=TEXT_LIMITS) -> dict[str, Column]:
    """Rule name -> condition under which a row breaks it."""
    return {f"{c} too long": F.length(c) > n for c, n in limits.items()}


def required_rules(*columns) -> dict[str, Column]:
    return {f"{c} missing": F.col(c).isNull() for c in columns}


def staging_rules() -> dict[str, Column]:
    return {**length_rules(), "unit_price out of range": F.abs("unit_price") >= PRICE_BOUND}


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of the rules they break."""
    broken = F.concat_ws("; ", *[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    marked = df.withColumn("failed_rules", broken)
    return (
        marked.where(F.col("failed_rules") == "").drop("failed_rules"),
        marked.where(F.col("failed_rules") != ""),
    )


def stage_transactions(df: DataFrame, source_file: str, loaded: Column) -> DataFrame:
    """Staging rows with dense ids, load date and source file.

    Ids follow the order of the row's values, so a reload of the same data gives the same ids.
    """
    facts = df.select(*FACTS).withColumn("unit_price", F.round("unit_price", 2).cast("decimal(10,2)"))
    keyed = dense_key_with_copies(facts, "transaction_id")
    return conform(
        keyed.withColumns({"load_date": loaded, "source_file": F.lit(source_file)}),
        "stg_retail_transactions",
    )


def profile_transactions(df: DataFrame, approximate=False) -> DataFrame:
    """Row, distinct and defect counts in one pass.

    `approximate` replaces the exact distinct counts, which carry every distinct value
    through a shuffle, by sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("total_rows"),
        distinct("invoice_no").alias("unique_invoices"),
        distinct("stock_code").alias("unique_products"),
        distinct("customer_id").alias("unique_customers"),
        distinct("country").alias("countries"),
        F.count_if(F.col("invoice_no").startswith(K.CANCELLED_PREFIX)).alias("cancelled_rows"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantity_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_ids"),
    )


PROFILED = {
    "unique_invoices": "invoice_no", "unique_products": "stock_code", "unique_customers": "customer_id",
    "countries": "country",
}
SKETCH_BITS = 14


def sketch_bound(bits: int = SKETCH_BITS) -> float:
    """Relative error that an estimate of `profile_from_sketches` keeps in all but 3 of 1,000 cases."""
    return 3 * 1.04 / 2 ** (bits / 2)


def profile_sketches(df: DataFrame, part="source_part", bits: int = SKETCH_BITS) -> DataFrame:
    """One row per source part: its counts, and a HyperLogLog sketch per profiled column.

    Store the rows: a new part adds its own row, and no old part is read again.
    """
    return df.groupBy(part).agg(
        F.count("*").alias("total_rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(name) for name, c in PROFILED.items()],
        F.count_if(F.col("invoice_no").startswith(K.CANCELLED_PREFIX)).alias("cancelled_rows"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantity_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_ids"),
    )


def profile_from_sketches(sketches: DataFrame) -> DataFrame:
    """The profile of all parts together; distinct counts are estimates within `sketch_bound`."""
    sums = ("total_rows", "cancelled_rows", "negative_quantity_rows", "missing_customer_ids")

    def one(name):
        if name in sums:
            return F.coalesce(F.sum(name), F.lit(0)).alias(name)
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name)

    return sketches.agg(*[one(c) for c in sketches.columns if c in sums or c in PROFILED])


def source_inventory(df: DataFrame, part="source_part") -> DataFrame:
    """Rows and columns per part."""
    names = [c for c in df.columns if c != part]
    return df.groupBy(part).agg(
        F.count("*").alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        F.lit(", ".join(names)).alias("column_names"),
    )


def source_sample(df: DataFrame, order, n=5, part="source_part") -> DataFrame:
    """The first `n` rows of every part."""
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return df.withColumn("sample_row", place).where(F.col("sample_row") <= n)
