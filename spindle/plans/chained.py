"""Loops whose steps are chained by files and can be resumed.

Step i writes its whole output into ``<folder>/step-000i`` and then, in one
rename, a marker with what was observed while writing; step i + 1 reads that
output from the files. A loop started again in the same folder (after its driver
was lost) finds the last step that has a marker, clears a later folder without
one (a half-written step) and goes on from there. A step's plan reads files, so
it is one step long, and a lost executor repeats a part of one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .loops import iterate

_MARKER = "observed.json"


class StepFolder:
    """The versioned step folders of one loop, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def step(self, i: int) -> str:
        return f"{self.path}/step-{i:06d}"

    def observed(self, i: int) -> dict | None:
        """What step i observed; None if it has not been finished."""
        marker = self._at(f"{self.step(i)}.{_MARKER}")
        if not self._fs.exists(marker):
            return None
        stream = self._fs.open(marker)
        try:
            text = self._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
        finally:
            stream.close()
        return json.loads(str(text))

    def commit(self, i: int, observed: dict) -> None:
        draft = self._at(f"{self.path}/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(observed).encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._at(f"{self.step(i)}.{_MARKER}")):
            raise RuntimeError(f"cannot mark {self.step(i)} as finished")

    def clear(self, i: int) -> None:
        """Removes step i, its marker first."""
        self._fs.delete(self._at(f"{self.step(i)}.{_MARKER}"), False)
        self._fs.delete(self._at(self.step(i)), True)

    def last(self) -> int:
        """The last finished step, -1 if there is none."""
        if not self._fs.exists(self._at(self.path)):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        done = [int(n[5:11]) for n in names if n.startswith("step-") and n.endswith(_MARKER)]
        return max(done, default=-1)


def chain(spark: SparkSession, folder: str, start: Callable[[], DataFrame], step: Callable[[DataFrame, int], DataFrame],
          write: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame], metrics: Callable[[DataFrame], dict[str, Column]] | None = None,
          n: int | None = None, until: Callable[[dict], bool] | None = None, keep: int = 2, on_step: Callable[[int, dict], None] | None = None) -> DataFrame:
    """Runs ``step`` over files ``n`` times, or until ``until(observed)`` holds,
    and returns the last step's output as read from its files.

    ``start`` gives what is written as step 0; ``step(state, i)`` makes step i from the read output of step i - 1. ``metrics``
    names aggregates of a step's result, observed while it is written (no extra
    job). The last ``keep`` steps stay in ``folder``."""
    steps = StepFolder(spark, folder)

    def save(frame: DataFrame, i: int) -> dict:
        steps.clear(i)
        named = metrics(frame) if metrics else {}
        if named:
            watch = Observation()
            frame = frame.observe(watch, *[c.alias(k) for k, c in named.items()])
        write(frame, steps.step(i))
        seen = dict(watch.get) if named else {}
        steps.commit(i, seen)
        if i >= keep:
            steps.clear(i - keep)
        if on_step is not None:
            on_step(i, seen)
        return seen

    at = steps.last()
    if at < 0:
        save(start(), 0)
        at = 0
    if (n is not None and at >= n) or (at > 0 and until is not None and until(steps.observed(at))):
        return read(steps.step(at))
    first = at

    def one(state: DataFrame, i: int) -> DataFrame:
        save(step(state, first + i + 1), first + i + 1)
        return read(steps.step(first + i + 1))

    return iterate(read(steps.step(at)), one, n=None if n is None else n - at, checkpoint_every=0,
                   until=None if until is None else lambda _, __, i: until(steps.observed(first + i + 1)))
