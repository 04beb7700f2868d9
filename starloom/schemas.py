"""Declared schemas and the fixed vocabulary of the source files."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Null tokens of the delimited files, id placeholders, junk header patterns,
# integer limit, digit patterns and the calendar range. They must equal what the source files use.
# --------------------------------------------------------------------------------------
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
ID_PLACEHOLDERS = ("", "nan", "none")
JUNK_HEADER = r"(?i)^unnamed|^_c\d+$|^$"
INT_MAX = 2147483647
NOT_A_DIGIT = "[^0-9]"
NOT_DIGIT_OR_DOT = "[^0-9.]"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
MISSING_LEVEL = "N/A"
# Date spellings besides ISO, tried in this order; month before day. The pattern
# decides, so that a text goes through one parser only.
DATE_FORMATS = (
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$", "yyyy/M/d H:mm"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
)
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

ID = T.StringType()
TEXT = T.StringType()
INT = T.IntegerType()
KEY = T.LongType()
# Prices as read; a quantity times a price and sums of those keep all ten places.
MONEY = T.DecimalType(27, 10)
TOTAL = T.DecimalType(38, 10)
# A number is read through this type first: a price that differs from it would be rounded.
WIDE_NUMBER = T.DecimalType(38, 20)
STAMP = T.TimestampNTZType()
DATE = T.DateType()
FLAG = T.BooleanType()

# Where a row stood in its source: slice (order in which sources were listed or loaded), file,
# block (a run of rows of limited length inside the file) and row. Sorting by it gives load order.
POSITION_TYPE = T.StructType([
    T.StructField("slice", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])
POSITION = "line_pos"
# Staging tables whose load order matters later; the others drop the position.
ORDERED_TABLES = frozenset({
    "stg_line_item_data_products", "stg_line_item_data_prices", "stg_user_data", "stg_user_job",
    "stg_merchant_data", "stg_staff_data"})


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


STAGING = {
    "stg_order_data": _table(
        order_id=ID, user_id=ID, estimated_arrival=INT, transaction_date=STAMP),
    "stg_order_delays": _table(order_id=ID, delay_in_days=INT),
    "stg_line_item_data_products": _table(order_id=ID, product_name=TEXT, product_id=ID),
    "stg_line_item_data_prices": _table(order_id=ID, price=MONEY, quantity=INT),
    # all text, and any further source column is kept as well
    "stg_order_with_merchant_data": _table(order_id=ID, merchant_id=ID, staff_id=ID),
    "stg_campaign_data": _table(
        campaign_id=ID, campaign_name=TEXT, campaign_description=TEXT, discount=MONEY),
    "stg_transactional_campaign_data": _table(
        transaction_date=STAMP, campaign_id=ID, order_id=ID, estimated_arrival=INT, availed=INT),
    "stg_user_data": _table(
        user_id=ID, creation_date=STAMP, name=TEXT, street=TEXT, state=TEXT, city=TEXT,
        country=TEXT, birthdate=DATE, gender=TEXT, device_address=TEXT, user_type=TEXT,
        possible_duplicate=FLAG, possible_duplicate_of=ID),
    "stg_user_job": _table(
        user_id=ID, name=TEXT, job_title=TEXT, job_level=TEXT,
        possible_duplicate=FLAG, possible_duplicate_of=ID),
    "stg_user_credit_card": _table(
        user_id=ID, name=TEXT, credit_card_number=TEXT, issuing_bank=TEXT),
    "stg_product_list": _table(product_id=ID, product_name=TEXT, product_type=TEXT, price=MONEY),
    "stg_merchant_data": _table(
        merchant_id=ID, creation_date=STAMP, name=TEXT, street=TEXT, state=TEXT, city=TEXT,
        country=TEXT, contact_number=TEXT, possible_duplicate=FLAG, possible_duplicate_of=ID),
    "stg_staff_data": _table(
        staff_id=ID, name=TEXT, job_level=TEXT, street=TEXT, state=TEXT, city=TEXT, country=TEXT,
        contact_number=TEXT, creation_date=STAMP, possible_duplicate=FLAG,
        possible_duplicate_of=ID),
}

STAR = {
    "dim_date": _table(
        date_key=INT, full_date=DATE, year=INT, quarter=INT, month=INT, day=INT,
        day_name=TEXT, month_name=TEXT, is_weekend=FLAG),
    "dim_user": _table(
        user_key=KEY, source_user_id=ID, name=TEXT, birthdate=DATE, gender=TEXT, user_type=TEXT,
        city=TEXT, state=TEXT, country=TEXT, job_title=TEXT, job_level=TEXT),
    "dim_merchant": _table(
        merchant_key=KEY, source_merchant_id=ID, name=TEXT, city=TEXT, state=TEXT, country=TEXT),
    "dim_staff": _table(
        staff_key=KEY, source_staff_id=ID, name=TEXT, job_level=TEXT, city=TEXT, country=TEXT),
    "dim_product": _table(
        product_key=KEY, product_id=ID, product_name=TEXT, product_type=TEXT, base_price=MONEY),
    "dim_campaign": _table(
        campaign_key=KEY, campaign_id=ID, campaign_name=TEXT, description=TEXT, discount=MONEY),
    "fact_orders": _table(
        order_key=KEY, order_id=ID, user_key=KEY, merchant_key=KEY, staff_key=KEY,
        campaign_key=KEY, date_key=INT, delay_in_days=INT, total_amount=TOTAL),
    "fact_order_items": _table(
        order_item_key=KEY, order_id=ID, product_key=KEY, user_key=KEY, merchant_key=KEY,
        campaign_key=KEY, date_key=INT, quantity=INT, unit_price=MONEY,
        total_price=TOTAL),
    "fact_campaign_performance": _table(
        campaign_perf_key=KEY, campaign_key=KEY, date_key=INT, total_orders=INT,
        total_revenue=TOTAL, average_order_value=T.DecimalType(38, 8),
        unique_customers=INT),
}

# Who a user was, and when: published by a rebuild that keeps versions.
USER_VERSIONS = _table(
    version_key=KEY, **{f.name: f.dataType for f in STAR["dim_user"].fields[1:]},
    valid_from=STAMP, valid_to=STAMP, is_current=FLAG)

# Constraints of the star schema: unique columns, columns that may not be NULL, references.
UNIQUE = {
    "stg_order_data": ("order_id",),
    "dim_date": ("date_key", "full_date"),
    "dim_user": ("user_key",),
    "dim_merchant": ("merchant_key",),
    "dim_staff": ("staff_key",),
    "dim_product": ("product_key",),
    "dim_campaign": ("campaign_key", "campaign_id"),
    "fact_orders": ("order_key", "order_id"),
    "fact_order_items": ("order_item_key",),
    "fact_campaign_performance": ("campaign_perf_key",),
}
GENERATED_KEYS = frozenset({
    "user_key", "merchant_key", "staff_key", "product_key", "campaign_key", "order_key",
    "order_item_key", "campaign_perf_key", "version_key"})
NOT_NULL = {
    "dim_user": ("source_user_id",),
    "dim_merchant": ("source_merchant_id",),
    "dim_staff": ("source_staff_id",),
    "dim_product": ("product_id",),
    "dim_campaign": ("campaign_id",),
    "fact_orders": ("order_id",),
}
REFERENCES = {
    "fact_orders": {
        "user_key": "dim_user", "merchant_key": "dim_merchant", "staff_key": "dim_staff",
        "campaign_key": "dim_campaign", "date_key": "dim_date"},
    "fact_order_items": {
        "product_key": "dim_product", "user_key": "dim_user", "merchant_key": "dim_merchant",
        "campaign_key": "dim_campaign", "date_key": "dim_date"},
    "fact_campaign_performance": {"campaign_key": "dim_campaign", "date_key": "dim_date"},
}
