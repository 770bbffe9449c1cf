"""Column-expression helpers and reusable distributed building blocks."""
from marginlens.functions.exprs import (  # noqa: F401
    date_key, exact_avg, exact_sum, fixed, key_month, key_year, month_key, ratio_of_sums, sum_units,
    quarter_label, safe_div, weekday_name,
)
from marginlens.functions.joins import join_checked  # noqa: F401
from marginlens.functions.quantiles import group_medians  # noqa: F401
