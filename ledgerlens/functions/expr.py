"""Column-expression helpers that reproduce pandas / Python scalar semantics
inside Catalyst (no Python UDFs, everything stays in whole-stage codegen).

The helpers are resolved at *plan time*: alias chains look at ``df.columns``
once, and the resulting expression is a plain Column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, FloatType, NumericType,
                               StringType)

POS_INF = float("inf")
NEG_INF = float("-inf")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(a: str | Column, b: str | Column) -> Column:
    """``a / b`` with IEEE-754 results for a zero divisor (pandas semantics):
    x/0 = ±inf, 0/0 = NaN; null stays null. Spark's ANSI ``/`` would raise."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(a > 0, F.lit(POS_INF))
            .when(a < 0, F.lit(NEG_INF))
            .otherwise(F.lit(float("nan"))))


def pd_true(cond: Column, *nan_guard: str | Column) -> Column:
    """Truth value of a pandas comparison: null -> False and any NaN operand
    -> False (Spark orders NaN above every number, pandas compares it False)."""
    out = cond
    for c in nan_guard:
        out = out & ~F.isnan(col(c))
    return F.coalesce(out, F.lit(False))


def flag(cond: Column, *nan_guard: str | Column) -> Column:
    """``(cond).astype(int)`` with pandas null/NaN semantics."""
    return pd_true(cond, *nan_guard).cast("int")


def safe_double(c: str | Column, default: float) -> Column:
    """``float(x)`` that falls back to ``default`` for null / unparsable input
    (a plain cast raises under ANSI mode)."""
    return F.coalesce(col(c).try_cast("double"), F.lit(float(default)))


def clip01(c: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """``max(lo, min(hi, x))`` in Python order: ``least`` first, so NaN -> hi
    (``min(1.0, nan)`` returns 1.0 in Python)."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.nanvl(c.cast("double"), F.lit(hi))))


def bround0_int(c: Column) -> Column:
    """Python ``round`` (half-even) to an int."""
    return F.bround(c, 0).cast("int")


def first_present(df: DataFrame | Sequence[str], names: Sequence[str]) -> str | None:
    """First of ``names`` present as a column (``dict.get`` chains test key
    presence, not value)."""
    cols = df.columns if isinstance(df, DataFrame) else list(df)
    for n in names:
        if n in cols:
            return n
    return None


def field_or(df: DataFrame, names: Sequence[str], default) -> Column:
    """Column of the first present alias, else a literal default."""
    name = first_present(df, names)
    return F.col(name) if name is not None else F.lit(default)


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def truthy_py(df: DataFrame, name: str | None) -> Column:
    """Python ``bool(x)``: non-empty string (even "False"), non-zero number,
    NaN -> True; null / missing -> False."""
    if name is None or name not in df.columns:
        return F.lit(False)
    c, t = F.col(name), _dtype(df, name)
    if isinstance(t, BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(t, StringType):
        return F.coalesce(F.length(c) > 0, F.lit(False))
    if isinstance(t, (DoubleType, FloatType)):
        return F.coalesce((c != 0) | F.isnan(c), F.lit(False))
    if isinstance(t, NumericType):
        return F.coalesce(c != 0, F.lit(False))
    return F.col(name).isNotNull()


TRUTHY_TEXT = ["1", "true", "yes", "y", "fraud", "anomaly"]


def truthy_text(df: DataFrame, name: str | None) -> Column:
    """Case-manager boolean: strings in {1,true,yes,y,fraud,anomaly} after
    strip+lower; other types by truthiness."""
    if name is None or name not in df.columns:
        return F.lit(False)
    t = _dtype(df, name)
    if isinstance(t, StringType):
        return F.coalesce(F.lower(py_strip(F.col(name))).isin(TRUTHY_TEXT), F.lit(False))
    return truthy_py(df, name)


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace), unlike Spark ``trim``."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def safe_str(df: DataFrame, names: Sequence[str], default: str) -> Column:
    """``_safe_str(record.get(a, record.get(b, ...)), default)``."""
    name = first_present(df, names)
    if name is None:
        return F.lit(default)
    s = py_strip(F.col(name).cast("string"))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def prob_from(df: DataFrame, names: Sequence[str], default: float) -> Column:
    """``_clip_probability(record.get(a, record.get(b, default)))``: alias by
    presence, null/unparsable -> 0.0 default of the cast, then clip."""
    name = first_present(df, names)
    if name is None:
        return clip01(F.lit(float(default)))
    return clip01(_to_double(df, name, 0.0))


def _to_double(df: DataFrame, name: str, default: float) -> Column:
    c = F.col(name)
    if isinstance(_dtype(df, name), StringType):
        c = py_strip(c)
    return F.coalesce(c.try_cast("double"), F.lit(float(default)))


def to_double(df: DataFrame, name: str, default: float) -> Column:
    return _to_double(df, name, default)


def fmt3(c: Column) -> Column:
    """``f"{x:.3f}"`` (Spark rounds half-up on the decimal value; exact
    binary ties may differ in the last digit — text only)."""
    return F.format_string("%.3f", c)


def ordered_nonnull(items: Iterable[Column]) -> Column:
    """Array of the non-null items, in order, first occurrence of each
    (list.append under if). ``array_except`` with a null-only array keeps
    order and stays inside whole-stage codegen (a lambda ``filter`` would
    be interpreted); every caller builds items that are distinct anyway."""
    arr = F.array(*items)
    return F.array_except(arr, F.array(F.lit(None)))
