"""Layer contracts (StructTypes) and the projection that conforms a frame.

The contracts follow the layered table definitions of the shop: bronze
documents, cleansed (silver) tables and marts (gold).  ``conform`` makes a
frame match a contract exactly: contract order, missing columns as typed
NULLs, mistyped columns cast with ``try_cast``, extra columns dropped.
Partition columns are part of the contract and typed STRING.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: column contracts of the layered tables ---
_SCD2_TAIL = (
    "effective_date timestamp_ntz, expiry_date timestamp_ntz, is_current boolean, "
    "version_number int, record_hash string, pipeline_load_ts timestamp_ntz, load_date string"
)
CONTRACTS: dict[str, str] = {
    "bronze_customers": (
        "_id string, customer_id string, first_name string, last_name string, email string, phone string, "
        "address string, city string, country string, status string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, raw_document string, load_date string"
    ),
    "bronze_orders": (
        "_id string, order_id string, customer_id string, total_amount double, currency string, status string, "
        "items string, shipping_addr string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "raw_document string, load_date string"
    ),
    "bronze_products": (
        "_id string, product_id string, name string, category string, sub_category string, price double, "
        "stock_qty int, attributes string, status string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "raw_document string, load_date string"
    ),
    "bronze_payments": (
        "_id string, payment_id string, order_id string, customer_id string, amount double, currency string, "
        "method string, gateway string, status string, created_at timestamp_ntz, raw_document string, load_date string"
    ),
    "bronze_reviews": (
        "_id string, review_id string, product_id string, customer_id string, rating tinyint, title string, "
        "body string, status string, created_at timestamp_ntz, raw_document string, load_date string"
    ),
    "silver_payments": (
        "payment_id string, order_id string, customer_id string, amount double, currency string, method string, "
        "gateway string, status string, created_at timestamp_ntz, record_hash string, "
        "pipeline_load_ts timestamp_ntz, load_date string"
    ),
    "silver_reviews": (
        "review_id string, product_id string, customer_id string, rating int, title string, body string, "
        "status string, created_at timestamp_ntz, record_hash string, pipeline_load_ts timestamp_ntz, load_date string"
    ),
    "silver_customers": (
        "customer_id string, first_name string, last_name string, full_name string, email string, "
        "phone string, address string, city string, state string, country string, zip_code string, "
        "status string, loyalty_points int, created_at timestamp_ntz, updated_at timestamp_ntz, " + _SCD2_TAIL
    ),
    "silver_orders": (
        "order_id string, customer_id string, status string, total_amount double, currency string, "
        "items_count int, total_items_qty int, shipping_city string, shipping_country string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, record_hash string, "
        "pipeline_load_ts timestamp_ntz, load_date string"
    ),
    "silver_products": (
        "product_id string, name string, category string, sub_category string, price double, "
        "cost double, stock_qty int, sku string, weight_kg double, status string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, " + _SCD2_TAIL
    ),
    "gold_customer_sales_summary": (
        "customer_id string, full_name string, email string, country string, total_orders bigint, "
        "total_revenue double, avg_order_value double, first_order_date timestamp_ntz, "
        "last_order_date timestamp_ntz, customer_segment string, lifetime_value_tier string, "
        "pipeline_load_ts timestamp_ntz, report_date string"
    ),
    "gold_top_products": (
        "product_id string, product_name string, category string, sub_category string, "
        "total_units_sold bigint, total_revenue double, avg_rating double, review_count bigint, "
        "return_rate double, rank_in_category int, pipeline_load_ts timestamp_ntz, report_date string"
    ),
    "gold_order_analytics": (
        "order_date string, country string, category string, total_orders bigint, "
        "completed_orders bigint, cancelled_orders bigint, total_revenue double, "
        "avg_order_value double, completion_rate double, pipeline_load_ts timestamp_ntz, report_date string"
    ),
}
PARTITION_COLUMNS = {
    "bronze_customers": ("load_date",),
    "bronze_orders": ("load_date",),
    "bronze_products": ("load_date",),
    "bronze_payments": ("load_date",),
    "bronze_reviews": ("load_date",),
    "silver_payments": ("load_date",),
    "silver_reviews": ("load_date",),
    "silver_customers": ("load_date",),
    "silver_orders": ("load_date",),
    "silver_products": ("load_date",),
    "gold_customer_sales_summary": ("report_date",),
    "gold_top_products": ("report_date",),
    "gold_order_analytics": ("report_date",),
}
# --- end of fixed values ---


def contract(name: str) -> StructType:
    return StructType.fromDDL(CONTRACTS[name])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_table(spark: SparkSession, table: str, name: str, location: str) -> None:
    """Register an external parquet table over ``location`` with the contract."""
    schema = contract(name)
    parts = PARTITION_COLUMNS.get(name, ())
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part} LOCATION '{location}'")


def write_table(spark: SparkSession, df: DataFrame, table: str, name: str, location: str, partition: str) -> None:
    """Overwrite one partition of a catalog table that has the contract
    ``name``; the table is created if need be.  The write itself adds the
    partition to the catalog, so nothing lists the root."""
    create_table(spark, table, name, location)
    (column,) = PARTITION_COLUMNS[name]
    rows = conform(df, contract(name)).drop(column)
    rows.createOrReplaceTempView(f"{table}_rows")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{partition}') SELECT * FROM {table}_rows")
    finally:
        spark.catalog.dropTempView(f"{table}_rows")


def register_silver(spark: SparkSession, view: str, name: str, root: str) -> None:
    """(Re)create a catalog view of the live rows of a cleansed table, in the
    shape of its contract.  It names the folders of the newest version, so it
    is to be called again after a publish."""
    from strata.sources import manifest

    version = manifest.newest(spark, root)
    if version is None:
        raise RuntimeError(f"nothing has been published under {root}")

    def rows_of(folder: manifest.Folder) -> str:
        have = set(folder.struct().names)
        columns = ", ".join(
            f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
            if f.name in have
            else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in contract(name).fields
        )
        return f"SELECT {columns} FROM parquet.`{root}/{folder.folder}`"

    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + " UNION ALL ".join(map(rows_of, version.current)))


def repair(spark: SparkSession, table: str) -> None:
    """Discover partitions written by jobs (``MSCK REPAIR TABLE``)."""
    spark.catalog.recoverPartitions(table)
