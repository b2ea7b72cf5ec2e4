from .category import customer_category
from .dates import MonthWindow, month_bounds, month_window
from .hashing import row_fingerprint, row_hash

__all__ = [
    "MonthWindow",
    "customer_category",
    "month_bounds",
    "month_window",
    "row_fingerprint",
    "row_hash",
]
