"""Anomalies per station against a state that survives restarts and expires.

The state of a station is three numbers: how many values it has reported, their
mean and their summed squared deviations. A value is an anomaly if it lies
more than ``width`` standard deviations from the mean of what the station
reported in earlier arrivals. A batch's values are compared with the state as it
was before the batch and then merged into it, so their order does not matter and
nothing is held but the numbers, however many rows a hot station sends at once.

The state lives in the stream's checkpoint (RocksDB). A station that is silent
for ``keep_days`` of event time loses its state and starts anew.

Stations are dealt to ``groups`` by a hash of their name, and the state of a
group holds the numbers of all its stations side by side. Spark hands a group's
state to Python with its rows, so what a call costs is paid once for each group
and not for each station, and a batch's stations are compared and merged as
arrays. A group's timer is that of its first station to expire.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "station array<string>, n array<bigint>, mean array<double>, m2 array<double>, latest array<bigint>"
OUTPUT = "event_id bigint, station_id string, value double, mean double, deviation double"
GROUPS = 1024  # a checkpoint belongs to the number it was begun with


def _pooled(n, mean, m2, k, own, squares):
    """Two sets of values as one, from the number, mean and summed squared
    deviations of each: the pairwise update. Single numbers or arrays; k > 0."""
    delta = own - mean
    total = n + k
    return total, mean + delta * k / total, m2 + squares + delta * delta * n * k / total


def merge(n: int, mean: float, m2: float, values: pd.Series) -> tuple[int, float, float]:
    """The state of a station with more values."""
    if not len(values):
        return n, mean, m2
    own = float(values.mean())
    return _pooled(n, mean, m2, len(values), own, float(((values - own) ** 2).sum()))


def merge_all(n: np.ndarray, mean: np.ndarray, m2: np.ndarray, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The states of many stations with more values; value i is of station ``at[i]``."""
    use, first, of = np.unique(at, return_index=True, return_inverse=True)
    if not len(use):
        return n, mean, m2
    k, begin = np.bincount(of), values[first]
    # summed from one of the station's own values, so that equal values have their mean exactly
    own = begin + np.bincount(of, weights=values - begin[of]) / k
    squares = np.bincount(of, weights=(values - own[of]) ** 2)
    n, mean, m2 = n.copy(), mean.copy(), m2.copy()
    n[use], mean[use], m2[use] = _pooled(n[use], mean[use], m2[use], k, own, squares)
    return n, mean, m2


def _grown(x: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([x, np.zeros(size - len(x), x.dtype)])


def _judge(width: float, least: int, keep_days: int) -> Callable[[tuple, Iterable[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    keep_ms = keep_days * 86_400_000

    def run(key: tuple, rows: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [], [], [], [])
        names = pd.Index(held[0], dtype=object)
        n, mean, m2, latest = (np.array(x, t) for x, t in zip(held[1:], (np.int64, np.float64, np.float64, np.int64)))
        before, before_mean, deviation = n, mean, np.sqrt(m2 / np.maximum(n, 1))
        for batch in () if state.hasTimedOut else rows:
            at = names.get_indexer(batch["station_id"])
            if (at < 0).any():
                names = names.append(pd.Index(batch["station_id"][at < 0].unique(), dtype=object))
                before, before_mean, deviation, n, mean, m2, latest = (_grown(x, len(names)) for x in (before, before_mean, deviation, n, mean, m2, latest))
                at = names.get_indexer(batch["station_id"])
            np.maximum.at(latest, at, batch["ms"].to_numpy())
            known = batch["value"].notna().to_numpy()
            at, value, event = at[known], batch["value"].to_numpy()[known], batch["event_id"][known]
            odd = (before[at] >= least) & (np.abs(value - before_mean[at]) > width * deviation[at])
            if odd.any():
                own = at[odd]
                yield pd.DataFrame({"event_id": event[odd], "station_id": names[own], "value": value[odd], "mean": before_mean[own], "deviation": deviation[own]})
            n, mean, m2 = merge_all(n, mean, m2, at, value)
        stay = latest + keep_ms >= state.getCurrentWatermarkMs()
        if not stay.any():
            state.remove()
            return
        state.update((names[stay].tolist(), *(x[stay].tolist() for x in (n, mean, m2, latest))))
        state.setTimeoutTimestamp(int(latest[stay].min()) + keep_ms)

    return run


def anomalies(stream: DataFrame, delay: str = "1 DAY", width: float = 3.0, least: int = 5, keep_days: int = 30, groups: int = GROUPS) -> DataFrame:
    """Rows of a stream (event_id, at, station_id, value) that are anomalies, with
    the mean and deviation they were compared with; stations with fewer than
    ``least`` earlier values have none. Rows without a station or a time belong to
    no state and are left out, as are rows later than ``delay``."""
    rows = stream.filter(F.col("station_id").isNotNull() & F.col("at").isNotNull()).withWatermark("at", delay)
    rows = rows.select("event_id", "at", "station_id", F.col("value").cast("double").alias("value"), F.unix_millis("at").alias("ms"),
                       F.pmod(F.xxhash64("station_id"), F.lit(groups)).alias("station_group"))
    return rows.groupBy("station_group").applyInPandasWithState(
        _judge(width, least, keep_days), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
