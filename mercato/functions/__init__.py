"""Column-level functions (scalar expressions) of the engine."""

from .scalar import (calendar_columns, day_name, elapsed_days, expm1, line_total, log1p,  # noqa: F401
                     parse_time, safe_div, weekday0, year_month)
