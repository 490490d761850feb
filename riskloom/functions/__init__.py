"""Scalar column expressions; all built-in Spark functions (JVM-side, codegen)."""

from riskloom.functions.scalar import (
    accuracy_percent,
    parse_double,
    parse_int,
    round_half_even,
    verdict_code,
    verdict_colour,
    verdict_message,
)

__all__ = [
    "accuracy_percent",
    "parse_double",
    "parse_int",
    "round_half_even",
    "verdict_code",
    "verdict_colour",
    "verdict_message",
]
