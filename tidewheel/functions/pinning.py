"""Compute costly columns once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def pinned(
    df: DataFrame, keep: Sequence[str], computed: Mapping[str, Column], per_step: int = 16
) -> DataFrame:
    """``keep`` plus the ``computed`` columns, each evaluated once per row.

    Catalyst copies an expression to every place that uses its column, and moves filters below
    the projection that computes it. For nested expressions such as JSON validation the copies
    multiply. A generator over a one-element array gives the same rows and is a step that
    projections and filters are not moved across.

    ``per_step`` columns share a generator. Each generator compiles to one method, and the JVM
    only ever interprets a method of more than 8000 bytes: give large expressions few per step.
    """
    names = list(computed)
    out = df
    kept = list(keep)
    for at in range(0, len(names), per_step):
        step = names[at : at + per_step]
        row = F.struct(*[computed[name].alias(name) for name in step])
        # Columns that later steps still read stay until the last one.
        carried = kept if at + per_step >= len(names) else list(dict.fromkeys([*out.columns, *kept]))
        out = out.select(*carried, F.inline(F.array(row)))
        kept += step
    return out
