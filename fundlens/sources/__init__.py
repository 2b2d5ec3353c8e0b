"""Sources and sinks: the campaigns view over driver tables, CSV/Parquet/JSON IO."""

from .campaigns import CAMPAIGN_COLUMNS, campaigns, load_table  # noqa: F401
