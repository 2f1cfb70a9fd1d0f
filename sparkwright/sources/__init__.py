"""Sources: typed CSV scans, schema-as-table, counts, previews, and the views
that turn the shared test tables into the ``flights`` and ``sms`` inputs."""

from .csv import (FLIGHTS_SCHEMA, SMS_SCHEMA, column_types, read_flights_csv, read_sms_csv,
                  read_with_rejects, write_flights_csv, write_sms_csv)
from .inspect import preview, row_count, schema_table
from .views import flights, sms

__all__ = [
    "FLIGHTS_SCHEMA", "SMS_SCHEMA", "read_flights_csv", "read_sms_csv",
    "read_with_rejects", "column_types", "write_flights_csv", "write_sms_csv", "preview", "row_count", "schema_table",
    "flights", "sms",
]
