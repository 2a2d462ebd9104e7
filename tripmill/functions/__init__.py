"""Column expressions shared by the operators."""

from tripmill.functions.numbers import average, ratio, round_rows, round_to
from tripmill.functions.text import key_values, trip_key
from tripmill.functions.times import date_key, file_month, iso_weekday, minute_number, ntz, seconds_between

__all__ = [
    "average",
    "date_key",
    "file_month",
    "iso_weekday",
    "key_values",
    "minute_number",
    "ntz",
    "ratio",
    "round_rows",
    "round_to",
    "seconds_between",
    "trip_key",
]
