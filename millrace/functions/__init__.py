from millrace.functions.columns import (
    alt_label,
    choice_prompt,
    id_to_name,
    is_missing,
    map_value,
    mask_labels,
    name_to_id,
    null_if,
    parse_response,
    positive_score,
    row_hash,
    threshold_label,
    to_type,
)

__all__ = [
    "alt_label",
    "choice_prompt",
    "id_to_name",
    "is_missing",
    "map_value",
    "mask_labels",
    "name_to_id",
    "null_if",
    "parse_response",
    "positive_score",
    "row_hash",
    "threshold_label",
    "to_type",
]
