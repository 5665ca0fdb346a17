"""Column contracts and table schemas of the sales star."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the source job's contract: the eight required
# columns of a sales file, in contract order.
REQUIRED_COLUMNS = (
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
)
# Name of the column that carries the folded extra columns of a file.
ADDITIONAL_COLUMN = "additional_column"
# Bookkeeping columns the reader adds: raw text of a malformed row, and the
# file a row came from. Headers may not use these names.
CORRUPT_COLUMN = "_corrupt_record"
SOURCE_FILE_COLUMN = "_src_file"

MONEY = T.DecimalType(12, 2)
MONEY_TOTAL = T.DecimalType(18, 2)

# Types of the contract columns when a sales file is parsed. Keys are read as
# 64-bit so that key spaces beyond 2^31 parse instead of turning into rejects.
CONTRACT_TYPES: dict[str, T.DataType] = {
    "customer_id": T.LongType(),
    "store_id": T.LongType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
}

SALES_SCHEMA = T.StructType(
    [T.StructField(c, CONTRACT_TYPES[c], True) for c in REQUIRED_COLUMNS]
    + [T.StructField(ADDITIONAL_COLUMN, T.StringType(), True)]
)

# The columns of the dimension tables and the ledger.
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("first_name", T.StringType(), True),
    T.StructField("last_name", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("pincode", T.StringType(), True),
    T.StructField("phone_number", T.StringType(), True),
    T.StructField("customer_joining_date", T.DateType(), True),
])

STORE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("store_pincode", T.StringType(), True),
    T.StructField("store_manager_name", T.StringType(), True),
    T.StructField("store_opening_date", T.DateType(), True),
    T.StructField("reviews", T.StringType(), True),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("current_price", T.DecimalType(10, 2), True),
    T.StructField("old_price", T.DecimalType(10, 2), True),
    T.StructField("created_date", T.TimestampType(), True),
    T.StructField("updated_date", T.TimestampType(), True),
    T.StructField("expiry_date", T.DateType(), True),
])

SALES_TEAM_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("first_name", T.StringType(), True),
    T.StructField("last_name", T.StringType(), True),
    T.StructField("manager_id", T.IntegerType(), True),
    T.StructField("is_manager", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("pincode", T.StringType(), True),
    T.StructField("joining_date", T.DateType(), True),
])

# Append-only file ledger: one event per (run, file, status change).
LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("file_location", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("event_ts", T.TimestampType(), False),
    T.StructField("seq", T.LongType(), False),
])

# Ledger status codes: 'A' = file taken into a run, 'I' = run finished with it.
STATUS_OPEN = "A"
STATUS_DONE = "I"
# Of this library: the file was set aside.
STATUS_SET_ASIDE = "Q"
