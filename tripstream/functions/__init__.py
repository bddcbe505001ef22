"""Scalar functions as Column expressions (F1–F15) and their SQL registration."""

from .geo import (cells_on_way, direction_angle, direction_bucket, distance_km, is_in_nyc,
                  to_cell_id, to_coords)
from .sql import register_sql_functions
from .text import STOP_WORDS, address_of, month_of, tokens
from .time import (format_ride_time, parse_iso_zoned, parse_mbox_date, parse_ride_time,
                   time_diff_ms, travel_minutes)

__all__ = [
    "cells_on_way", "direction_angle", "direction_bucket", "distance_km", "is_in_nyc",
    "to_cell_id", "to_coords", "register_sql_functions", "STOP_WORDS", "address_of",
    "month_of", "tokens", "format_ride_time", "parse_iso_zoned", "parse_mbox_date",
    "parse_ride_time", "time_diff_ms", "travel_minutes",
]
