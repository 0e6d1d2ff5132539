"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from weft.functions.columns import (  # noqa: F401
    any_of,
    clean_name_camel,
    clean_name_dummies,
    comb2,
    one_hot,
    safe_ratio,
    yes_no,
)
