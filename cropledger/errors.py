"""Error classes (V4).

Query misuse raises a Python exception before any plan is built. Data errors
never raise: each cleaned row carries an ``errors`` array of
``struct<code, value>`` whose ``code`` is one of the class names below.
"""


class CropLedgerError(Exception):
    """Base class."""


class ImproperlyConfigured(CropLedgerError):
    pass


class InvalidSource(CropLedgerError):
    pass


class InvalidCurrency(CropLedgerError):
    pass


class InvalidAmount(CropLedgerError):
    pass


class InvalidCountry(CropLedgerError):
    pass


class InvalidQuery(CropLedgerError):
    pass


class InvalidRows(CropLedgerError):
    """Rows that a write refuses: ``counts`` tells how many break each rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = dict(sorted(counts.items()))
        super().__init__(", ".join(f"{rule}: {n} rows" for rule, n in self.counts.items()))


# data error codes written into the ``errors`` column of cleaned rows
ERR_CURRENCY = "InvalidCurrency"
ERR_AMOUNT = "InvalidAmount"
ERR_COUNTRY = "InvalidCountry"
ERR_SOURCE = "InvalidSource"
