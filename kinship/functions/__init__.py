"""Column expressions shared by the plans. All are built-in Spark functions,
so they stay inside whole-stage code generation; no Python UDF is used."""

from kinship.functions.columns import (
    epoch_days,
    is_digits,
    render_follow_report,
    tokens,
    trim_controls,
)

__all__ = ["epoch_days", "is_digits", "render_follow_report", "tokens", "trim_controls"]
