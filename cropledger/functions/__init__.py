"""Column-expression functions used by cleaning, queries and exports."""

from cropledger.functions.amount import avg_half_even, half_even_cents, parse_amount, sum_amount, to_amount
from cropledger.functions.text import (
    collapse_spaces,
    entity_id,
    fingerprint,
    first_usable,
    fold_ascii,
    has_fingerprint,
    normalize_scheme,
    null_token,
    pack_ids,
    packed,
    scheme_id,
    trim_cell,
    unpack_ids,
    unpacked,
    usable,
)

__all__ = [
    "avg_half_even",
    "collapse_spaces",
    "entity_id",
    "fingerprint",
    "first_usable",
    "fold_ascii",
    "half_even_cents",
    "has_fingerprint",
    "normalize_scheme",
    "null_token",
    "pack_ids",
    "packed",
    "parse_amount",
    "scheme_id",
    "sum_amount",
    "to_amount",
    "trim_cell",
    "unpack_ids",
    "unpacked",
    "usable",
]
