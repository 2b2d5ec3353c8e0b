"""Schemas of the campaign table."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the campaigns view built from the driver tables, in order.
CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("goal", T.DoubleType()),
    T.StructField("pledged", T.DoubleType()),
    T.StructField("backers_count", T.IntegerType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("launched_at", T.LongType()),
    T.StructField("deadline", T.LongType()),
    T.StructField("staff_pick", T.BooleanType()),
    T.StructField("state", T.IntegerType()),
    T.StructField("blurb", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("creator", T.StringType()),
])

# The 41 columns of the raw campaign CSV export, in file order,
# with their logical types (integer epochs as long, flags as boolean).
RAW_CSV_COLUMNS = [
    ("backers_count", "int"), ("blurb", "string"), ("category", "string"),
    ("converted_pledged_amount", "long"), ("country", "string"),
    ("country_displayable_name", "string"), ("created_at", "long"), ("creator", "string"),
    ("currency", "string"), ("currency_symbol", "string"), ("currency_trailing_code", "boolean"),
    ("current_currency", "string"), ("deadline", "long"), ("disable_communication", "boolean"),
    ("friends", "string"), ("fx_rate", "double"), ("goal", "double"), ("id", "long"),
    ("is_backing", "string"), ("is_starrable", "boolean"), ("is_starred", "string"),
    ("launched_at", "long"), ("location", "string"), ("name", "string"),
    ("permissions", "string"), ("photo", "string"), ("pledged", "double"),
    ("profile", "string"), ("slug", "string"), ("source_url", "string"),
    ("spotlight", "boolean"), ("staff_pick", "boolean"), ("state", "int"),
    ("state_changed_at", "long"), ("static_usd_rate", "double"), ("urls", "string"),
    ("usd_pledged", "double"), ("usd_type", "string"), ("ratio", "double"),
    ("language", "string"), ("usd_exchange_rate", "string"),
]

_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
          "string": T.StringType(), "boolean": T.BooleanType()}

RAW_CSV_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in RAW_CSV_COLUMNS])

# Columns a validated campaign table must carry.
REQUIRED_COLUMNS = ["category", "country", "goal", "state", "launched_at", "deadline", "staff_pick"]

# Columns that may not be null after validation (the ingestion default).
DEFAULT_NOT_NULL = ["category", "country", "launched_at", "deadline"]

# The seven model input columns.
MODEL_COLUMNS = ["goal", "category", "country", "launched_at", "deadline", "staff_pick", "state"]
