"""Keyed change detector (T4) with periodic refresh (T5).

``groupBy(series).transformWithStateInPandas`` keeps one value per series in
the state store (RocksDB provider: spills to disk, changelog checkpointing).
Within a micro-batch a series' rows are put in arrival order
``(src_partition, src_offset)`` and compared as strings with the previous value;
the first row is compared with the stored value. Rows of a series in one
micro-batch are bounded by the trigger size (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``).

With ``refresh_s`` every stored series is re-emitted at each wall-clock tick
(epoch-aligned multiples of the period) with its latest value, stamped with the
tick, through one processing-time timer per series.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.change import with_series
from ..session import use_rocksdb
from ..workers import ship_by_value

ship_by_value(__name__)

OUTPUT_SCHEMA = (
    "kind STRING, key STRING, series STRING, measurement STRING, tags STRING, field STRING, value STRING, "
    "ts_ns BIGINT, src_partition INT, src_offset BIGINT, line STRING"
)
STATE_SCHEMA = "measurement STRING, tags STRING, field STRING, value STRING"
_COLS = ["kind", "key", "series", "measurement", "tags", "field", "value", "ts_ns", "src_partition", "src_offset", "line"]


def _head(measurement: str, tags: str) -> str:
    return measurement if not tags else f"{measurement},{tags}"


class _Ticks(StatefulProcessor):
    """Refresh ticks on the wall clock: ticks missed in a pause are not made up for."""

    refresh_ms: int | None

    def next_tick(self, timerValues) -> int:
        return (timerValues.getCurrentProcessingTimeInMs() // self.refresh_ms + 1) * self.refresh_ms


class ChangeProcessor(_Ticks):
    """Emit a row when a series is new or its value text differs from the stored one."""

    def __init__(self, refresh_ms: int | None = None, ttl_ms: int | None = None):
        self.refresh_ms = refresh_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values(["src_partition", "src_offset"], kind="stable").reset_index(drop=True)
        stored = self.last.get() if self.last.exists() else None
        prev = pdf["value"].shift(1)
        prev.iloc[0] = stored[3] if stored is not None else None
        changed = prev.isna() | (pdf["value"] != prev)
        out = pdf[changed]
        tail = pdf.iloc[-1]
        self.last.update((tail["measurement"], tail["tags"], tail["field"], tail["value"]))
        if self.refresh_ms and stored is None and not list(self.handle.listTimers()):
            self.handle.registerTimer(self.next_tick(timerValues))
        if len(out):
            heads = [_head(m, t) for m, t in zip(out["measurement"], out["tags"])]
            ts = out["ts_ns"]
            lines = [
                f"{h} {f}={v}" + ("" if pd.isna(t) else f" {int(t)}")
                for h, f, v, t in zip(heads, out["field"], out["value"], ts)
            ]
            yield pd.DataFrame(
                {
                    "kind": "change",
                    "key": (out["measurement"] + "#" + out["field"]).values,
                    "series": out["series"].values,
                    "measurement": out["measurement"].values,
                    "tags": out["tags"].values,
                    "field": out["field"].values,
                    "value": out["value"].values,
                    "ts_ns": ts.astype("Int64").values,
                    "src_partition": out["src_partition"].astype("Int32").values,
                    "src_offset": out["src_offset"].astype("Int64").values,
                    "line": lines,
                }
            )[_COLS]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.last.exists():
            return  # expired state: its timer ends with it
        t = self.next_tick(timerValues) - self.refresh_ms
        self.handle.registerTimer(t + self.refresh_ms)
        m, tags, f, v = self.last.get()
        series = key[0]
        yield pd.DataFrame(
            {
                "kind": ["refresh"],
                "key": [series],
                "series": [series],
                "measurement": [m],
                "tags": [tags],
                "field": [f],
                "value": [v],
                "ts_ns": pd.array([t * 1_000_000], dtype="Int64"),
                "src_partition": pd.array([None], dtype="Int32"),
                "src_offset": pd.array([None], dtype="Int64"),
                "line": [f"{_head(m, tags)} {f}={v} {t}000000"],
            }
        )[_COLS]

    def close(self) -> None:
        pass


class ChangeRowProcessor(_Ticks):
    """Row-based form of ``ChangeProcessor`` (``transformWithState``): no pandas frame per
    series, which matters when a micro-batch touches many small series."""

    def __init__(self, refresh_ms: int | None = None, ttl_ms: int | None = None):
        self.refresh_ms = refresh_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        from pyspark.sql import Row

        batch = sorted(rows, key=lambda r: (r["src_partition"], r["src_offset"]))
        stored = self.last.get()
        prev = stored[3] if stored is not None else None
        for r in batch:
            v = r["value"]
            if prev is None or v != prev:
                head = _head(r["measurement"], r["tags"])
                ts = r["ts_ns"]
                yield Row(
                    kind="change", key=f"{r['measurement']}#{r['field']}", series=r["series"], measurement=r["measurement"],
                    tags=r["tags"], field=r["field"], value=v, ts_ns=ts, src_partition=r["src_partition"],
                    src_offset=r["src_offset"], line=f"{head} {r['field']}={v}" + ("" if ts is None else f" {ts}"),
                )
            prev = v
        tail = batch[-1]
        self.last.update((tail["measurement"], tail["tags"], tail["field"], tail["value"]))
        if self.refresh_ms and stored is None:
            self.handle.registerTimer(self.next_tick(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        from pyspark.sql import Row

        stored = self.last.get()
        if stored is None:
            return  # expired state: its timer ends with it
        t = self.next_tick(timerValues) - self.refresh_ms
        self.handle.registerTimer(t + self.refresh_ms)
        m, tags, f, v = stored
        series = key[0]
        yield Row(kind="refresh", key=series, series=series, measurement=m, tags=tags, field=f, value=v,
                  ts_ns=t * 1_000_000, src_partition=None, src_offset=None, line=f"{_head(m, tags)} {f}={v} {t}000000")

    def close(self) -> None:
        pass


def _changes_in_group(key, pdfs, state):
    """``applyInPandasWithState`` body: the stored value travels with the group, so a
    series costs no state-server round trip (used when no refresh timer is needed)."""
    pdf = pd.concat(list(pdfs), ignore_index=True)
    pdf = pdf.sort_values(["src_partition", "src_offset"], kind="stable").reset_index(drop=True)
    stored = state.get if state.exists else None
    prev = pdf["value"].shift(1)
    prev.iloc[0] = stored[3] if stored is not None else None
    out = pdf[prev.isna() | (pdf["value"] != prev)]
    tail = pdf.iloc[-1]
    state.update((tail["measurement"], tail["tags"], tail["field"], tail["value"]))
    if len(out):
        heads = [_head(m, t) for m, t in zip(out["measurement"], out["tags"])]
        ts = out["ts_ns"]
        yield pd.DataFrame(
            {
                "kind": "change",
                "key": (out["measurement"] + "#" + out["field"]).values,
                "series": out["series"].values,
                "measurement": out["measurement"].values,
                "tags": out["tags"].values,
                "field": out["field"].values,
                "value": out["value"].values,
                "ts_ns": ts.astype("Int64").values,
                "src_partition": out["src_partition"].astype("Int32").values,
                "src_offset": out["src_offset"].astype("Int64").values,
                "line": [f"{h} {f}={v}" + ("" if pd.isna(t) else f" {int(t)}") for h, f, v, t in zip(heads, out["field"], out["value"], ts)],
            }
        )[_COLS]


def detect_changes(fields: DataFrame, refresh_s: int | None = None, ttl_s: int | None = None, rows: bool = True,
                   engine: str | None = None) -> DataFrame:
    """T4/T5 on a (streaming or batch) field-row DataFrame; append-mode output."""
    use_rocksdb(fields.sparkSession)
    x = with_series(fields).select(
        "series", "measurement", "tags", "field", "value", "ts_ns", "src_partition", "src_offset"
    )
    # "rows" (transformWithState, measured fastest), "pandas" (transformWithStateInPandas) or
    # "group_state" (applyInPandasWithState, no timers: change detection only)
    engine = engine or ("rows" if rows else "pandas")
    if engine == "group_state" and (refresh_s or ttl_s):
        raise ValueError("group_state engine has no timers; use rows or pandas for refresh/ttl")
    if engine == "group_state":
        return x.groupBy("series").applyInPandasWithState(
            _changes_in_group, OUTPUT_SCHEMA, STATE_SCHEMA, "append", "NoTimeout"
        )
    cls = ChangeRowProcessor if engine == "rows" else ChangeProcessor
    proc = cls(
        refresh_ms=int(refresh_s * 1000) if refresh_s else None,
        ttl_ms=int(ttl_s * 1000) if ttl_s else None,
    )
    grouped = x.groupBy("series")
    run = grouped.transformWithState if engine == "rows" else grouped.transformWithStateInPandas
    return run(
        statefulProcessor=proc,
        outputStructType=OUTPUT_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if refresh_s else "None",
    )
