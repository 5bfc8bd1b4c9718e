"""Causal operators on streams: the run-counting latch and the target follower keep their state between batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "key string, i long, x double, on boolean"


def latch_step(state: tuple[bool, int], x: float | None, on_t: float, off_t: float, on_rows: int, off_rows: int) -> tuple[bool, int]:
    """State and run length after one value; a missing value counts as far above both thresholds."""
    on, run = state
    x = 99.0 if x is None or x != x else x
    run = run + 1 if (x > off_t if on else x < on_t) else 0
    return (not on, 0) if run >= (off_rows if on else on_rows) else (on, run)


class Latch(StatefulProcessor):
    """On after ``on_rows`` values under ``on_t``, off after ``off_rows`` over ``off_t``; rows of a key in order of i."""

    def __init__(self, on_t: float, off_t: float, on_rows: int = 4, off_rows: int = 3):
        self.args = (on_t, off_t, on_rows, off_rows)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latch", "on boolean, run int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        have = self.state.get()
        state = (bool(have[0]), int(have[1])) if have else (False, 0)
        for pdf in [pd.concat(list(rows))]:
            pdf = pdf.sort_values("i")
            on = []
            for x in pdf["x"]:
                state = latch_step(state, x, *self.args)
                on.append(state[0])
            yield pd.DataFrame({"key": str(key[0]), "i": pdf["i"], "x": pdf["x"], "on": on})
        self.state.update(state)

    def close(self) -> None:
        pass


def latch_stream(rows: DataFrame, on_t: float, off_t: float, on_rows: int = 4, off_rows: int = 3) -> DataFrame:
    """``rows``: a stream of key, i, x.  State lives in the state store of the query (RocksDB)."""
    return rows.groupBy("key").transformWithStateInPandas(Latch(on_t, off_t, on_rows, off_rows), OUT, outputMode="Append", timeMode="None")


class SetReset(StatefulProcessor):
    """On by ``enter``, off by ``leave``; on wins."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("on", "on boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        have = self.state.get()
        on = bool(have[0]) if have else False
        pdf = pd.concat(list(rows)).sort_values("i")
        out = []
        for enter, leave in zip(pdf["enter"], pdf["leave"], strict=True):
            on = bool(enter) or (on and not leave)
            out.append(on)
        self.state.update((on,))
        yield pd.DataFrame({"key": str(key[0]), "i": pdf["i"], "on": out})

    def close(self) -> None:
        pass


def set_reset_stream(rows: DataFrame) -> DataFrame:
    """``rows``: a stream of key, i, enter, leave."""
    return rows.groupBy("key").transformWithStateInPandas(SetReset(), "key string, i long, on boolean", outputMode="Append", timeMode="None")
