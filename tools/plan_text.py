"""Executed-plan text helpers shared by the plan tools and tests."""

from __future__ import annotations


def final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` block of an adaptive plan's text,
    including those of nested subquery plans, and keep the final plans."""
    kept: list[str] = []
    skip_from: int | None = None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_from is not None:
            # The block's root sits at the marker's depth, its children deeper.
            if indent >= skip_from:
                continue
            skip_from = None
        if "== Initial Plan ==" in line:
            skip_from = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def executed_plan(df) -> str:
    return final_only(df._jdf.queryExecution().executedPlan().toString())
