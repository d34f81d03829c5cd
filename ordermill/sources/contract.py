"""The raw tables: file names, column order, types and storage layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class RawTable:
    """One raw source. ``columns`` is ordered; types are those after ingest."""

    columns: dict[str, str]
    partition_by: str | None = None
    multiline: bool = False
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def text_schema(self) -> StructType:
        """All columns as text, as they are stored in the file."""
        return StructType([StructField(name, StringType()) for name in self.columns])


# The raw contract, spelling of the source included.
RAW_TABLES: dict[str, RawTable] = {
    "orders": RawTable(
        {
            "order_id": "string",
            "customer_id": "string",
            "order_status": "string",
            "order_purchase_timestamp": "timestamp",
            "order_approved_at": "timestamp",
            "order_delivered_carrier_date": "timestamp",
            "order_delivered_customer_date": "timestamp",
            "order_estimated_delivery_date": "timestamp",
        },
        partition_by="order_status",
    ),
    "customers": RawTable(
        {
            "customer_id": "string",
            "customer_unique_id": "string",
            "customer_zip_code_prefix": "int",
            "customer_city": "string",
            "customer_state": "string",
        }
    ),
    "order_items": RawTable(
        {
            "order_id": "string",
            "order_item_id": "int",
            "product_id": "string",
            "seller_id": "string",
            "shipping_limit_date": "timestamp",
            "price": "double",
            "freight_value": "double",
        },
        partition_by="shipping_year",
        derived={"shipping_year": "year(shipping_limit_date)"},
    ),
    "payments": RawTable(
        {
            "order_id": "string",
            "payment_sequential": "int",
            "payment_type": "string",
            "payment_installments": "int",
            "payment_value": "double",
        },
        partition_by="payment_type",
    ),
    "reviews": RawTable(
        {
            "review_id": "string",
            "order_id": "string",
            "review_score": "int",
            "review_comment_title": "string",
            "review_comment_message": "string",
            "review_creation_date": "timestamp",
            "review_answer_timestamp": "timestamp",
        },
        partition_by="review_score",
        multiline=True,
    ),
    "products": RawTable(
        {
            "product_id": "string",
            "product_category_name": "string",
            "product_name_lenght": "double",
            "product_description_lenght": "double",
            "product_photos_qty": "double",
            "product_weight_g": "double",
            "product_length_cm": "double",
            "product_height_cm": "double",
            "product_width_cm": "double",
        }
    ),
    "sellers": RawTable(
        {
            "seller_id": "string",
            "seller_zip_code_prefix": "int",
            "seller_city": "string",
            "seller_state": "string",
        }
    ),
    "geolocation": RawTable(
        {
            "geolocation_zip_code_prefix": "int",
            "geolocation_lat": "double",
            "geolocation_lng": "double",
            "geolocation_city": "string",
            "geolocation_state": "string",
        }
    ),
    "category_translation": RawTable(
        {"product_category_name": "string", "product_category_name_english": "string"}
    ),
}

# Column names are enough to tell ingestion metadata from data.
METADATA_PREFIX = "_"
