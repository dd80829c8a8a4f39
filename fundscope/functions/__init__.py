from fundscope.functions.columns import (  # noqa: F401
    GOAL_EDGES,
    GOAL_EDGES_FINE,
    KEEP_SUBCATEGORIES,
    bin_by_edges,
    bool_to_int,
    day_diff,
    epoch_to_date,
    goal_bin,
    has_text,
    hash_percent,
    hash_unit,
    indicator,
    keep_or_other,
    merge_bins,
    month_text,
    recode_state,
    split_first,
    text_length,
)
