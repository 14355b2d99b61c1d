from regiopanel.functions.expr import (  # noqa: F401
    code_prefix_filter,
    count_when,
    flag_sum,
    guarded_ratio,
    not_in_any,
    padded_code,
    padded_code_prefix_range,
    recode,
    rounded,
    sum_when,
    year_of,
    year_range_filter,
)
