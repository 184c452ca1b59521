"""Column functions: per-value rules of the loose contract (all built-ins but WKT)."""

from siltlake.functions.columns import (  # noqa: F401
    ZERO_DATE_TEXTS, binary_hex, bit_unsigned, csv_field, csv_line, hash_label, is_zero_date,
    key_hash, key_label, key_part_col, key_part_name, linear_hash_label, range_label,
    to_text, zero_date_null, zerofill,
)
from siltlake.functions.spatial import wkb_to_wkt, wkb_to_wkt_value  # noqa: F401
