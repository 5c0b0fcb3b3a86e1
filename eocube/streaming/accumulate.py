"""Running rain total as keyed state.

Cells land in any number of files, and a micro-batch may hold parts of several days.  A day is
whole once its end mark has landed behind it (:func:`eocube.streaming.steps.land_steps`): a row
without a cell.  End marks alone move the watermark, so the timer of a day fires when the day is
whole, and days are added in order whatever the order of their files.  Until then rows wait in
the state store by day; totals lie there by row of cells, so that a step rewrites only the rows
it touches.  A row of a day that is already closed fails the query instead of being added to
totals already emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eocube.functions.projection import WEB_MERCATOR
from eocube.model import GridSpec
from eocube.operators.regrid import reproject

MM_PER_M = 1000.0
#: Cells per side of a block that shares one key.
STATE_BLOCK = 64
DAY_MS = 86_400_000
_OUT = "day date, y_idx bigint, x_idx bigint, tp double"


def _make_processor(side: int, factor: float) -> StatefulProcessor:
    """The processor, its class nested so that it travels to executors by value."""
    import numpy as np
    import pandas as pd

    class RunningTotal(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.held = handle.getMapState("held", "day int", "cell array<int>, tp array<double>")
            self.totals = handle.getMapState("totals", "line int", "last array<int>, total array<double>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            closed = timerValues.getCurrentWatermarkInMs() // DAY_MS
            for frame in rows:
                cell = ((frame["y_idx"] % side) * side + frame["x_idx"] % side).to_numpy()
                value = frame["tp"].to_numpy(dtype="float64", na_value=np.nan)
                number = frame["number"].to_numpy()
                for day in np.unique(number).tolist():
                    if day <= closed:
                        raise ValueError(f"block {key}: day {day} arrived after its end mark")
                    now = number == day
                    cells, values = cell[now].tolist(), value[now].tolist()
                    before = self.held.getValue((day,))
                    if before is None:
                        # the end mark of the day stands at its midnight
                        self.handle.registerTimer(day * DAY_MS - 1)
                    else:
                        cells, values = [*before[0], *cells], [*before[1], *values]
                    self.held.updateValue((day,), (cells, values))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            day = (expiredTimerInfo.getExpiryTimeInMs() + 1) // DAY_MS
            cell, value = (np.array(x) for x in self.held.getValue((day,)))
            self.held.removeKey((day,))
            if len(np.unique(cell)) < len(cell):
                raise ValueError(f"block {key}: a cell of day {day} arrived twice")
            running = np.empty(len(cell))
            for line in np.unique(cell // side).tolist():
                of = np.flatnonzero(cell // side == line)
                place = cell[of] % side
                state = self.totals.getValue((line,))
                last, total = (np.array(x) for x in state or ([-(2**31)] * side, [0.0] * side))
                # a missing step is NaN and stays in the total from then on
                total[place] += value[of] * factor
                last[place] = day
                running[of] = total[place]
                self.totals.updateValue((line,), (last.tolist(), total.tolist()))
            yield pd.DataFrame(
                {
                    "day": np.full(len(cell), day, "datetime64[D]").astype("datetime64[ns]"),
                    "y_idx": key[0] * side + cell // side,
                    "x_idx": key[1] * side + cell % side,
                    "tp": running,
                }
            )

        def close(self) -> None:
            pass

    return RunningTotal()


def running_accumulate(stream: DataFrame, *, factor: float = MM_PER_M) -> DataFrame:
    """Every step's running total in millimetres, once the step is whole; a missing step ends a cell's total.

    ``stream`` holds ``(day, y_idx, x_idx, tp)`` with tp in metres, and rows without a cell as
    end marks.  Run it with a function of :mod:`eocube.streaming.steps`, which give the query the
    state store it needs.
    """
    block = [F.floor(F.col(c) / STATE_BLOCK).alias(f"block_{c[0]}") for c in ("y_idx", "x_idx")]
    # midnight of the day in UTC, whatever the session's zone
    mark = F.when(F.col("y_idx").isNull(), F.timestamp_seconds(F.unix_date("day").cast("bigint") * (DAY_MS // 1000)))
    totals = (
        stream.withColumn("mark", mark)
        .withWatermark("mark", "0 seconds")
        .where(F.col("mark").isNull())  # by the mark, or the filter would move below the watermark
        .select(F.unix_date("day").alias("number"), "y_idx", "x_idx", "tp", *block)
        .groupBy("block_y", "block_x")
        .transformWithStateInPandas(_make_processor(STATE_BLOCK, factor), _OUT, "append", "EventTime")
    )
    return totals.withColumn("tp", F.when(~F.isnan("tp"), F.col("tp")))


def close_stream(
    totals: DataFrame, spec: GridSpec, *, crs: str = WEB_MERCATOR, resolution: float = 500.0
) -> tuple[DataFrame, GridSpec]:
    """After the last step: all running totals on the fine metric grid, 0 as no-data."""
    return reproject(totals, spec, crs, ["tp"], "bilinear", resolution=resolution, keys=["day"], nodata=0.0)
