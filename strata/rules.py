"""Collection specifications and cleansing rule sets.

A ``CollectionSpec`` says how a source collection is keyed, which column is
its high-water mark and which slowly-changing-dimension type its cleansed
table keeps.  ``CleanseRules`` drive the single-projection cleansing operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Derived:
    """A derived column: SQL expression plus the input columns it needs.

    The column is only added when every input exists, so rule sets can be
    applied to frames that lack some optional columns.
    """

    name: str
    expr: str
    inputs: tuple[str, ...]


@dataclass(frozen=True)
class CleanseRules:
    required: tuple[str, ...] = ()
    string_cols: tuple[str, ...] = ()
    lower_cols: tuple[str, ...] = ("email", "status")
    ts_cols: tuple[str, ...] = ()
    numeric_cols: tuple[str, ...] = ()
    derived: tuple[Derived, ...] = ()
    drop_cols: tuple[str, ...] = ("raw_document", "source_collection")
    # Blank strings become NULL after trimming (off = reference behaviour,
    # where a blank required value passes the NULL check).
    blank_as_null: bool = False
    # Timestamps are naive UTC throughout, hence timestamp_ntz.
    ts_type: str = "timestamp_ntz"


@dataclass(frozen=True)
class CollectionSpec:
    name: str
    primary_key: str
    watermark_column: str
    scd_type: int
    rules: CleanseRules = field(default_factory=CleanseRules)
    source_database: str = "enterprise_db"
    # Row fingerprint: its encoding and columns that do not count as a change.
    fingerprint_mode: str = "compat"
    fingerprint_exclude: tuple[str, ...] = ()
    # Key buckets of the cleansed table: a merge rewrites those its keys fall
    # into.  About one per 256 MB to 1 GB of current rows; a divisor (or a
    # multiple) of the shuffle partitions makes few files.
    buckets: int = 1

    def __post_init__(self) -> None:
        if self.scd_type not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, got {self.scd_type}")
        if self.buckets < 1:
            raise ValueError(f"buckets must be positive, got {self.buckets}")


# --- fixed values: must equal the reference's rule sets and registry seeds ---
CUSTOMER_RULES = CleanseRules(
    required=("customer_id", "email"),
    string_cols=("first_name", "last_name", "email", "phone", "address", "city", "country", "status"),
    ts_cols=("created_at", "updated_at"),
    derived=(
        Derived(
            "full_name",
            "CONCAT(COALESCE(first_name,''), ' ', COALESCE(last_name,''))",
            ("first_name", "last_name"),
        ),
    ),
)
ORDER_RULES = CleanseRules(
    required=("order_id", "customer_id"),
    string_cols=("order_id", "customer_id", "currency", "status"),
    ts_cols=("created_at", "updated_at"),
    numeric_cols=("total_amount",),
)
PRODUCT_RULES = CleanseRules(
    required=("product_id", "name"),
    string_cols=("product_id", "name", "category", "sub_category", "status"),
    ts_cols=("created_at", "updated_at"),
    numeric_cols=("price", "stock_qty"),
)
PAYMENT_RULES = CleanseRules(
    required=("payment_id", "order_id"),
    string_cols=("payment_id", "order_id", "customer_id", "currency", "method", "gateway", "status"),
    ts_cols=("created_at",),
    numeric_cols=("amount",),
)
REVIEW_RULES = CleanseRules(
    required=("review_id", "product_id", "customer_id"),
    string_cols=("review_id", "product_id", "customer_id", "title", "body", "status"),
    ts_cols=("created_at",),
    numeric_cols=("rating",),
)

COLLECTIONS: dict[str, CollectionSpec] = {
    "customers": CollectionSpec("customers", "customer_id", "updated_at", 2, CUSTOMER_RULES),
    "orders": CollectionSpec("orders", "order_id", "updated_at", 1, ORDER_RULES),
    "products": CollectionSpec("products", "product_id", "updated_at", 2, PRODUCT_RULES),
    "payments": CollectionSpec("payments", "payment_id", "created_at", 1, PAYMENT_RULES),
    "reviews": CollectionSpec("reviews", "review_id", "created_at", 1, REVIEW_RULES),
}

# Columns that describe load/version bookkeeping rather than content; they are
# left out of row fingerprints.
AUDIT_COLUMNS = (
    "load_date",
    "pipeline_load_ts",
    "record_hash",
    "effective_date",
    "expiry_date",
    "is_current",
    "version_number",
)

# Open-ended validity of a current SCD2 row.
OPEN_END = "9999-12-31 23:59:59"

# Segmentation defaults of the customer mart.
REVENUE_TIERS = ((10000.0, "Platinum"), (5000.0, "Gold"), (1000.0, "Silver"))
REVENUE_FLOOR = "Bronze"
ORDER_TIERS = ((10, "High"), (3, "Medium"))
ORDER_FLOOR = "Low"
QUALIFYING_STATUSES = ("completed", "delivered")
# Registry: initial mark and the mart each collection feeds.
EPOCH_MARK = "1970-01-01 00:00:00"
GOLD_MARTS = {"customers": "customer_sales_summary", "orders": "order_analytics", "products": "top_products"}
# --- end of fixed values ---
