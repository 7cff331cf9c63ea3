"""Column-expression builders. Everything here returns a ``Column``; nothing
runs Python per row."""

from tessera.functions.strings import (
    as_col, java_split, java_trim, to_int, to_double, split_lines, tuple_string,
    contains_any, normalize_quotes,
)
from tessera.functions.dates import (
    parse_ymd, parse_hms, parse_date_time, date_label, times_label, WEEKDAYS,
    order_by_date, order_by_times,
)
from tessera.functions.numeric import exact_avg, exact_sum, safe_ratio

__all__ = [
    "as_col", "java_split", "java_trim", "to_int", "to_double", "split_lines",
    "tuple_string", "contains_any", "normalize_quotes",
    "parse_ymd", "parse_hms", "parse_date_time", "date_label", "times_label",
    "WEEKDAYS", "order_by_date", "order_by_times", "exact_avg", "exact_sum", "safe_ratio",
]
