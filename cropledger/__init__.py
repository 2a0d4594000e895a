"""Spark-native cleaning and analytics for public subsidy payment data.

The package reads messy per-country, per-year payment CSV files, cleans them
with column expressions (no Python row functions), stores one partitioned
payments table and serves grouped summaries through a lazy query builder.
"""

from cropledger.errors import (
    ImproperlyConfigured,
    InvalidAmount,
    InvalidCountry,
    InvalidCurrency,
    InvalidQuery,
    InvalidSource,
)

__version__ = "0.1.0"

__all__ = [
    "ImproperlyConfigured",
    "InvalidAmount",
    "InvalidCountry",
    "InvalidCurrency",
    "InvalidQuery",
    "InvalidSource",
]
