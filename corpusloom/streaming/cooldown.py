"""Circuit breaker per key over a stream of outcomes.

``threshold`` failures in a row open the circuit of a key for ``seconds``; a
success closes it and ends the streak; once the time is over, the next outcome
finds the streak at zero. State is one small row per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key string, ts timestamp, ok boolean, refused boolean, opened boolean, streak int"
#: Rows handed on at a time.
ROWS = 10_000
STATE = "streak int, until double, failures bigint, successes bigint"


def step(state: tuple, at: float, ok: bool, threshold: int, seconds: float) -> tuple[tuple, bool, bool]:
    """(state, refused, opened) after an outcome at a time in seconds."""
    streak, until, failures, successes = state
    refused = until > at
    if 0 < until <= at:
        streak, until = 0, 0.0
    if ok:
        return (0, 0.0, failures, successes + 1), refused, False
    streak += 1
    opened = threshold > 0 and streak >= threshold and seconds > 0
    return (streak, at + seconds if opened else until, failures + 1, successes), refused, opened


def cooldowns(outcomes: DataFrame, threshold: int = 3, seconds: float = 900) -> DataFrame:
    """Outcomes (key, ts, ok) with what the breaker did; rows of a key are taken in order of ts within a batch, of equal times successes first.

    The batch of one key is held as two arrays; ``maxFilesPerTrigger`` of the
    source bounds it.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (0, 0.0, 0, 0)
        # times and outcomes of the whole batch of the key, nine bytes a row: a frame alone is in no order
        parts = [(f["ts"].to_numpy(dtype="datetime64[us]"), f["ok"].to_numpy(dtype=bool)) for f in frames]
        times, good = (np.concatenate(x) for x in zip(*parts)) if parts else ((), ())
        order = np.lexsort((~np.asarray(good, dtype=bool), np.asarray(times, dtype="datetime64[us]")))
        for at in range(0, len(order), ROWS):
            rows = []
            for k in order[at : at + ROWS]:
                now, refused, opened = step(now, times[k].astype("int64") / 1e6, bool(good[k]), threshold, seconds)
                rows.append((key[0], pd.Timestamp(times[k]), bool(good[k]), refused, opened, now[0]))
            yield pd.DataFrame(rows, columns=["key", "ts", "ok", "refused", "opened", "streak"])
        state.update(now)

    return outcomes.groupBy("key").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
