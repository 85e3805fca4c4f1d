"""Extension: accept/revert decisions over a stream of attempts, a state for each project."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "project long, attempt long, accepted boolean, current_errors long, current_holes long"
STATE = "errors long, holes long"


def _judge(key, batches: Iterator, state: GroupState) -> Iterator:
    import pandas as pd

    best = state.get if state.exists else None
    rows = pd.concat(list(batches)).sort_values("attempt")
    out = []
    for r in rows.itertuples():
        new = (int(r.errors), int(r.holes))
        yes = not r.raised and (best is None or new < best)
        best = new if yes else best
        out.append((key[0], int(r.attempt), yes, *(best or (None, None))))
    if best is not None:
        state.update(best)
    yield pd.DataFrame(out, columns=["project", "attempt", "accepted", "current_errors", "current_holes"])


def judge_stream(attempts: DataFrame) -> DataFrame:
    """A decision for each attempt (project, attempt, errors, holes, raised) of a stream whose attempts arrive in order."""
    return attempts.groupBy("project").applyInPandasWithState(_judge, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
