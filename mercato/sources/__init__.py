"""Sources and sinks: test tables, the flat line view, CSV input, stage tables."""

from .tables import (EVENT_LINES_SQL, EVENT_TEXT_DATES_SQL, LINE_COLUMNS, SALES_LINES_SQL, TABLES,  # noqa: F401
                     event_lines, event_text_dates, read_table, row_key, sales_lines, table_path)
