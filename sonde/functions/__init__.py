from sonde.functions.columns import (  # noqa: F401
    binary_target, col, composite_id, is_missing, key_or_unknown, lookup, md5_of, multiclass_target,
    normal_flag, present, value_type)
