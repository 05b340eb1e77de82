"""Iteration helper (fixed count, or until a condition holds).

Each step's output is cut with ``DataFrame.checkpoint(eager=True)``: it is
written to the reliable checkpoint folder, so (a) the logical plan does not
grow with the iteration count, and (b) a lost executor only recomputes the
current step, never the whole loop. ``localCheckpoint`` is never used: its
blocks live on executors and vanish with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation

from ..session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into reliable storage and return the truncated DataFrame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_observing(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Cut ``df`` and return it with aggregates computed during that same
    job (Spark observable metrics): loop-steering scalars at no extra job."""
    obs = Observation()
    out = cut(df.observe(obs, *[m.alias(k) for k, m in metrics.items()]))
    return out, obs.get


def iterate(state: DataFrame, step: Callable[[DataFrame, int], DataFrame], n: int | None = None,
            until: Callable[[DataFrame, DataFrame, int], bool] | None = None,
            checkpoint_every: int = 1, max_iter: int = 10_000,
            on_step: Callable[[int, DataFrame], None] | None = None) -> DataFrame:
    """Run ``state = step(state, i)`` ``n`` times, or until ``until(prev, new, i)``.

    ``until`` must be cheap and bounded (a count or a one-row aggregate); if it
    does not hold after ``max_iter`` steps, that is an error, not a result.
    """
    if n is None and until is None:
        raise ValueError("give n or until")
    limit = n if n is not None else max_iter
    for i in range(limit):
        new = step(state, i)
        if checkpoint_every and (i + 1) % checkpoint_every == 0:
            new = cut(new)
        if on_step is not None:
            on_step(i, new)
        done = until(state, new, i) if until is not None else False
        state = new
        if done:
            return state
    if n is None:
        raise RuntimeError(f"no end after {max_iter} steps")
    return state
