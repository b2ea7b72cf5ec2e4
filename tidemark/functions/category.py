"""Customer tiering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def customer_category(account_type: Column, spent: Column, loaned: Column) -> Column:
    """Tier of a customer from account type, money spent and money borrowed.

    An unknown (NULL) amount does not reach its threshold.
    """
    # Account types, thresholds and labels.
    return (
        F.when(account_type == "Premium", "High Value Customer")
        .when(
            (account_type == "Standard") & ((spent > 1000) | (loaned > 50000)),
            "Potential High Value Customer",
        )
        .otherwise("Regular Customer")
    )
