"""The seven RAW tables: columns in file order and how each is loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

METADATA = ("_source_file", "_loaded_at")


@dataclass(frozen=True)
class RawTable:
    name: str
    columns: tuple[tuple[str, str], ...]
    daily: bool  # a dt=YYYY-MM-DD folder per day, else one folder for everything
    strict: bool  # a bad value aborts the load, else the bad row is left out
    multi_line: bool = False  # quoted fields may hold line breaks

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.names])

    @property
    def stored_schema(self) -> str:
        """Columns of the RAW table as written: typed columns, load metadata, load partitions."""
        typed = [f"{name} {'bigint' if kind == 'whole' else kind}" for name, kind in self.columns]
        return ", ".join([*typed, "_source_file string", "_loaded_at timestamp", "_load_day date", "_load string"])


def _text(names: str) -> tuple[tuple[str, str], ...]:
    return tuple((name, "string") for name in names.split())


# Column names, order and types of the files.
_RESTAURANTS = _text("_idx id name city rating rating_count cost cuisine lic_no link address menu")
_USERS = _text(
    "_idx user_id name email password age gender marital_status occupation monthly_income education family_size"
)
_FOOD = _text("_idx f_id item veg_or_non_veg")
_MENU = _text("_idx menu_id r_id f_id cuisine price")
_ORDERS = (
    ("order_id", "whole"),
    ("order_timestamp", "timestamp_ntz"),
    ("order_date", "date"),
    ("user_id", "whole"),
    ("r_id", "whole"),
    ("restaurant_city", "string"),
    ("cuisine", "string"),
    ("items_count", "whole"),
    ("sales_qty", "whole"),
    ("subtotal", "whole"),
    ("discount", "whole"),
    ("delivery_fee", "whole"),
    ("gst", "whole"),
    ("sales_amount", "whole"),
    ("currency", "string"),
    ("payment_method", "string"),
    ("order_status", "string"),
    ("customer_rating", "whole"),
    ("delivery_time_min", "whole"),
)
_ORDER_ITEMS = (
    ("order_item_id", "whole"),
    ("order_id", "whole"),
    ("r_id", "whole"),
    ("f_id", "string"),
    ("price", "whole"),
    ("quantity", "whole"),
    ("line_amount", "whole"),
)
_REVIEWS = (
    ("review_id", "whole"),
    ("order_id", "whole"),
    ("user_id", "whole"),
    ("restaurant_id", "whole"),
    ("rating", "whole"),
    ("comment", "string"),
    ("review_date", "date"),
)

TABLES = {
    table.name: table
    for table in (
        RawTable("restaurants", _RESTAURANTS, daily=True, strict=False),
        RawTable("users", _USERS, daily=False, strict=False),
        RawTable("food", _FOOD, daily=False, strict=False),
        RawTable("menu", _MENU, daily=False, strict=False),
        RawTable("orders", _ORDERS, daily=True, strict=True),
        RawTable("order_items", _ORDER_ITEMS, daily=True, strict=True),
        RawTable("reviews", _REVIEWS, daily=True, strict=True, multi_line=True),
    )
}
