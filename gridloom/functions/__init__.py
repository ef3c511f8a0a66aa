from gridloom.functions.convert import (
    CONVERTERS,
    numeric,
    to_date,
    to_datetime,
    to_double,
    to_integer,
    to_logical,
    to_time,
)
from gridloom.functions.dates import (
    calendar_year,
    first_event_date,
    fiscal_year,
    month_start,
    parse_date_ladder,
    week_start,
)
from gridloom.functions.text import (
    clean_names,
    clean_text,
    file_name,
    file_stem,
    has_data,
    is_missing_token,
    normalise_cell,
    parse_number,
    redaction_flag,
    squish,
    tidy,
)

__all__ = [
    "CONVERTERS",
    "calendar_year",
    "clean_names",
    "clean_text",
    "file_name",
    "file_stem",
    "first_event_date",
    "fiscal_year",
    "has_data",
    "is_missing_token",
    "month_start",
    "normalise_cell",
    "numeric",
    "parse_date_ladder",
    "parse_number",
    "redaction_flag",
    "squish",
    "tidy",
    "to_date",
    "to_datetime",
    "to_double",
    "to_integer",
    "to_logical",
    "to_time",
    "week_start",
]
