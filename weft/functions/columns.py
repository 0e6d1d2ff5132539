"""Column expressions that replace the row-at-a-time Python UDFs.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage code generation.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(x: Column | str, d: Column | str) -> Column:
    """``x / d`` as float32, 0.0 when ``d`` is 0 (the degree-ratio rule)."""
    x, d = F.col(x) if isinstance(x, str) else x, F.col(d) if isinstance(d, str) else d
    return F.when(d == 0, F.lit(0.0)).otherwise(x / d).cast("float")


def comb2(n: Column | str) -> Column:
    """Binomial coefficient C(n, 2) as a double."""
    n = F.col(n) if isinstance(n, str) else n
    return n * (n - 1) / 2.0


def clustering_coefficient(t: Column | str, d: Column | str) -> Column:
    """``t / C(d, 2)`` as float32; 0.0 when ``t`` or ``d`` is 0."""
    t, d = F.col(t) if isinstance(t, str) else t, F.col(d) if isinstance(d, str) else d
    return F.when((t == 0) | (d == 0), F.lit(0.0)).otherwise(t / comb2(d)).cast("float")


def cent_mean(c: Column | str) -> Column:
    """Mean of a measure with at most two decimals (money, day counts).

    Summed as exact integer cents, so the result does not depend on how rows
    are split over partitions or combined (a plain float ``avg`` does), then
    divided once.  Nulls are ignored like ``avg``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(F.round(c * 100).cast("long")) / F.count(c) / F.lit(100.0)


def yes_no(c: Column | str) -> Column:
    """'Yes' -> 1, 'No' -> 0, anything else -> null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "Yes", 1).when(c == "No", 0)


def one_hot(c: str, value: str, name: str | None = None) -> Column:
    """Indicator column ``{c}_{value}`` as bigint; null input gives 0."""
    return F.when(F.col(c) == F.lit(value), 1).otherwise(0).cast("long").alias(
        name or f"{c}_{value}"
    )


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of a list of boolean columns."""
    return functools.reduce(lambda a, b: a | b, conditions)


def clean_name_camel(name: str) -> str:
    """Column-name rule A: every capital but a leading one starts a part, as in
    ``i_p_address``; a blank before it stays a mark of its own, as in
    ``total__charges``.  Parentheses go; blanks and hyphens become marks."""
    parts = "".join(f"_{c}" if i and "A" <= c <= "Z" else c for i, c in enumerate(name))
    s = parts.replace("__", "_").lower().translate(str.maketrans(" -", "__", "()"))
    # fixed corrections of rule A
    return {"streaming_t_v": "streaming_tv", "customer_i_d": "customer_id"}.get(s, s)


def clean_name_dummies(name: str) -> str:
    """Column-name rule B: lower case; parentheses, blanks and hyphens each
    become an underscore (may leave double ones)."""
    return name.lower().translate(str.maketrans("() -", "____"))
