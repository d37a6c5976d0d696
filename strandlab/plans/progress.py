"""Phases of a run: what they took, and how far they are while they work."""

from __future__ import annotations

import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass
class Phases:
    """Seconds of each phase in the order of their beginnings. Where ``log`` is given it is called with a line on each phase's end,
    and every ``every`` seconds with the tasks that are done of those of its running jobs."""

    spark: SparkSession
    log: object = None
    every: float = 10.0
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def phase(self, name: str):
        context, group, done = self.spark.sparkContext, f"strandlab-{uuid.uuid4().hex}", threading.Event()
        context.setJobGroup(group, name)
        begin = time.monotonic()
        watch = threading.Thread(target=self._watch, args=(name, group, done), daemon=True)
        watch.start()
        try:
            yield
        finally:
            done.set()
            watch.join()
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - begin
            for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
                context.setLocalProperty(key, None)
        self._say(f"{name}: {self.seconds[name]:.1f} s")

    def _say(self, line: str) -> None:
        if self.log is not None:
            self.log(line)

    def _watch(self, name: str, group: str, done: threading.Event) -> None:
        tracker = self.spark.sparkContext.statusTracker()
        while self.log is not None and not done.wait(self.every):
            jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
            stages = [tracker.getStageInfo(s) for j in jobs if j is not None and j.status == "RUNNING" for s in j.stageIds]
            total, ready = sum(s.numTasks for s in stages if s), sum(s.numCompletedTasks for s in stages if s)
            self._say(f"{name}: {ready} of {total} tasks")
