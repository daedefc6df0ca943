"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""
from barlake.functions.exprs import (  # noqa: F401
    epoch_micros, nullif_zero, ordering_key, ratio_minus_one, log_ratio, round_doubles,
    safe_div, signed_quantity, notional, utc_wall_clock,
)
