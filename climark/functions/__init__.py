"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from climark.functions.calendar import (  # noqa: F401
    calendar_fields, month_onehot, next_day, parse_time, prepare_features,
    season_expr, season_label, season_onehot, season_order_expr,
)
from climark.functions.numeric import r6, round_half_even, safe_corr, safe_div  # noqa: F401
from climark.functions.sizing import bounded_broadcast  # noqa: F401
