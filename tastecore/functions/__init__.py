from tastecore.functions.columns import (
    at_most,
    binary_label,
    capitalise,
    project_items,
    safe_ratio,
    strip_quotes,
    text_slice,
    unit_hash,
)

__all__ = [
    "at_most",
    "binary_label",
    "capitalise",
    "project_items",
    "safe_ratio",
    "strip_quotes",
    "text_slice",
    "unit_hash",
]
