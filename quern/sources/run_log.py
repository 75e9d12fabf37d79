"""The log of a run: a row per event, with the counts that the writing jobs collect themselves.

A phase writes its tables through `Phase.written` or `Phase.seen`. Both observe the rows just before the write, so the job
that writes them counts them: no further scan, and in the last stage of the job, where a task that is run again (a
lost executor, a speculative copy) counts once. What comes into a phase is what its predecessor was seen to write.

The log is a folder of JSON lines that only Spark's writers touch, so it may lie in any store that Spark reads.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .shared import written

# A fixed value: the columns of the log.
LOG = ["run_id", "timestamp", "phase", "component", "source_id", "record_id", "status", "records_in", "records_out", "records_rejected", "duration_seconds", "error_message", "notes"]
_COUNTS = ("records_in", "records_out", "records_rejected")
LOG_SCHEMA = ", ".join(f"{c} {'long' if c in _COUNTS else 'double' if c == 'duration_seconds' else 'string'}" for c in LOG)


class Phase:
    """What a phase took in, passed on and rejected."""

    def __init__(self, records_in: int | None = None):
        self.records_in = records_in
        self._observed: list[tuple[Observation, bool]] = []
        self._sums = {"rows": 0, "passed": 0}
        self._kinds: dict[str, int] = {}

    def seen(self, df: DataFrame, passed: Column | None = None, kinds: dict[str, Column] | None = None) -> DataFrame:
        """df, whose rows are counted when it is written: all, those where `passed` holds (all without it), and by kind.

        Put it right before the write: what is shuffled after it may be counted twice when a task is lost.
        """
        what = Observation()
        ok = F.lit(True) if passed is None else F.coalesce(passed, F.lit(False))
        named = [F.count_if(c).alias(f"kind {k}") for k, c in (kinds or {}).items()]
        self._observed.append((what, passed is not None))
        return df.observe(what, F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("passed"), *named)

    def written(self, df: DataFrame, name: str, passed: Column | None = None, kinds: dict[str, Column] | None = None) -> DataFrame:
        """df written to the shared folder, counted by that job, and read again."""
        return written(self.seen(df, passed, kinds), name)

    def counts(self) -> dict[str, int]:
        """records_in, records_out and records_rejected of the tables that were written."""
        for what, judged in self._observed:
            found = what.get
            for k in self._sums:
                self._sums[k] += found[k]
            self._kinds |= {k.removeprefix("kind "): self._kinds.get(k.removeprefix("kind "), 0) + v for k, v in found.items() if k.startswith("kind ")}
            if judged and self.records_in is None:
                self.records_in = found["rows"]
        self._observed = []
        out = self._sums["passed"]
        came = out if self.records_in is None else self.records_in
        return {"records_in": came, "records_out": out, "records_rejected": came - out}

    @property
    def notes(self) -> str:
        return json.dumps(self._kinds) if self._kinds else ""


class RunLog:
    """Appends the events of a run below `path`; without a path they are kept in `events` only."""

    def __init__(self, spark: SparkSession, path: str | None, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id
        self.events: list[dict] = []

    def event(self, phase: str, component: str, status: str, **values) -> None:
        if odd := sorted(set(values) - set(LOG)):
            raise ValueError(f"no columns of the log: {', '.join(odd)}")
        row = {c: 0 if c in _COUNTS else 0.0 if c == "duration_seconds" else "" for c in LOG}
        row |= {"run_id": self.run_id, "timestamp": datetime.now(timezone.utc).isoformat(), "phase": phase, "component": component, "status": status} | values
        self.events.append(row)
        if self.path:
            self.spark.createDataFrame([tuple(row[c] for c in LOG)], LOG_SCHEMA).coalesce(1).write.mode("append").json(self.path)

    @contextmanager
    def phase(self, phase: str, component: str, records_in: int | None = None, source_id: str = "") -> Iterator[Phase]:
        """Logs the start, and the end with its counts, or the failure; both with the seconds between."""
        began, own = time.monotonic(), Phase(records_in)
        self.event(phase, component, "started", source_id=source_id)
        taken = lambda: {"source_id": source_id, "duration_seconds": round(time.monotonic() - began, 3)}
        try:
            yield own
            counts = own.counts()
        except Exception as e:
            self.event(phase, component, "failed", error_message=str(e)[:2000], **taken())
            raise
        self.event(phase, component, "completed", notes=own.notes, **counts, **taken())

    def out(self) -> int | None:
        """The rows that the last phase to be completed passed on."""
        return next((e["records_out"] for e in reversed(self.events) if e["status"] == "completed"), None)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The events of a log folder, of all runs."""
    return spark.read.schema(LOG_SCHEMA).json(path)
