"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from tessera.functions.json_values import (  # noqa: F401
    json_type,
    parse_json_line,
    variant_at,
    variant_to_int,
    variant_to_str,
)
from tessera.functions.metrics import count_when, null_guarded_ratio, sum_when, zero_guarded_ratio  # noqa: F401
from tessera.functions.time import format_iso_millis_utc, parse_iso_utc, utc_date  # noqa: F401
