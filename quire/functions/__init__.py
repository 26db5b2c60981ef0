from quire.functions.scalar import (
    unix_to_timestamp, unix_to_text, text_to_year, word_count, strip_list, normalize_text,
    tokens, year_to_date, safe_cast, is_missing,
)

__all__ = ["unix_to_timestamp", "unix_to_text", "text_to_year", "word_count", "strip_list",
           "normalize_text", "tokens", "year_to_date", "safe_cast", "is_missing"]
