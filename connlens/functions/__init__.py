from connlens.functions.expressions import (
    binary_label,
    class_name,
    field_at,
    in_hash_sample,
    key_hash,
    std_from_variance,
)

__all__ = [
    "binary_label",
    "class_name",
    "field_at",
    "in_hash_sample",
    "key_hash",
    "std_from_variance",
]
