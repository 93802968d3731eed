from .columns import as_date, date_text, joined_text, json_histogram, widen_float, year_text

__all__ = ["as_date", "date_text", "joined_text", "json_histogram", "widen_float", "year_text"]
