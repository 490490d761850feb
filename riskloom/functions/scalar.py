"""Scalar functions of the scoring path.

* parsing request text to numbers, strict (errors abort, like Python ``int``
  and ``float``) or tolerant (bad text becomes NULL and can be flagged);
* half-to-even rounding of predictions (Python ``round``, Spark ``bround``);
* verdict text / code / colour from a rounded prediction;
* accuracy as a percentage, always rounded up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.specs import (
    COLOUR_NEGATIVE,
    COLOUR_POSITIVE,
    VERDICT_CODE_NEGATIVE,
    VERDICT_CODE_POSITIVE,
    VerdictRule,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: str | Column, strict: bool = True) -> Column:
    """Text to int. Integer text only: '6.9' is rejected, as Python ``int`` does.

    Strict mode raises on bad text (ANSI cast); tolerant mode yields NULL.
    """
    return _parse(_col(c), "int", strict)


# decimal, exponent, infinity and not-a-number texts; a cast alone also takes '1.5f', '2d' and '0x1p3'
_DOUBLE_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def parse_double(c: str | Column, strict: bool = True) -> Column:
    """Text to double, as strict as Python ``float``."""
    return _parse(_col(c), "double", strict, _DOUBLE_TEXT)


def _parse(c: Column, to: str, strict: bool, pattern: str | None = None) -> Column:
    # try_cast has the same result whatever the session's ANSI setting; the
    # strict form raises on text that try_cast rejects.
    parsed = c.try_cast(to)
    if pattern:
        parsed = F.when(c.cast("string").rlike(pattern), parsed)
    if not strict:
        return parsed
    return F.when(
        c.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot parse as {to}: "), c.cast("string"))).cast(to),
    ).otherwise(parsed)


def round_half_even(c: str | Column, to_int: bool = True) -> Column:
    """Python ``round(float(x))``: half to even (0.5 -> 0, 1.5 -> 2)."""
    r = F.bround(_col(c).cast("double"), 0)
    return r.cast("int") if to_int else r


def _is_match(prediction: Column, rule: VerdictRule) -> Column:
    # NULL predictions fall to the default branch, like any non-matching value.
    return F.coalesce(prediction == F.lit(rule.match_value), F.lit(False))


def _is_positive(prediction: Column, rule: VerdictRule) -> Column:
    m = _is_match(prediction, rule)
    return m if rule.match_is_positive else ~m


def verdict_message(prediction: str | Column, rule: VerdictRule) -> Column:
    p = _is_positive(_col(prediction), rule)
    return F.when(p, F.lit(rule.positive_message)).otherwise(F.lit(rule.negative_message))


def verdict_code(prediction: str | Column, rule: VerdictRule) -> Column:
    p = _is_positive(_col(prediction), rule)
    return F.when(p, F.lit(VERDICT_CODE_POSITIVE)).otherwise(F.lit(VERDICT_CODE_NEGATIVE))


def verdict_colour(prediction: str | Column, rule: VerdictRule) -> Column:
    code = verdict_code(prediction, rule)
    return F.when(code == F.lit(VERDICT_CODE_NEGATIVE), F.lit(COLOUR_NEGATIVE)).otherwise(
        F.lit(COLOUR_POSITIVE)
    )


def accuracy_percent(accuracy: str | Column) -> Column:
    """``ceil(accuracy * 100)``; NULL (not an error) for an empty or NaN accuracy."""
    a = _col(accuracy)
    return F.when(a.isNull() | F.isnan(a), F.lit(None).cast("bigint")).otherwise(
        F.ceil(a * F.lit(100.0))
    )
