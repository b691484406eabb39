"""Column expressions shared by the operators and plans."""

from tellerline.functions.columns import (
    amount_of,
    any_changed,
    bank_or_unknown,
    key_bucket,
    split_amounts,
    stamped,
)

__all__ = ["amount_of", "any_changed", "bank_or_unknown", "key_bucket", "split_amounts", "stamped"]
