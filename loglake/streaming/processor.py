"""Planned micro-batch loop: fetch -> process -> commit, with exact throttles.

One iteration (``Processor.step``):

1. a bounds snapshot of the controller's topics (from the records of a
   ``LogTable``) against the positions held in memory -- resolved from the
   offset store once, at registration -> P rows on the driver (metadata);
2. if the lag is 0, or the gate declines, nothing happens;
3. the controller's throttle rule turns the positions into a plan (P rows);
4. the plan is written ahead (``<wal>/batch_id=n.json``, a small file written
   by the driver) together with the id of the commit it will make and the
   sequence numbers that the commit will store;
5. the plan's ranges are read (pushed-down range scan), the batch is handed to
   ``process(df, batch_id)``;
6. on success the stops are committed. On failure nothing is committed and
   the stop hook runs; the next run finds that no key of the write-ahead plan
   has been stored since and replays *the same ranges* under the same batch id,
   so a sink that overwrites by batch id gets each record exactly once
   (at-least-once delivery, exactly-once effect). A plan whose ranges have left
   the log is data loss. A plan that a later commit (a seek) overtook is void:
   the batch id is planned anew from the stored positions.

A processor owns its (group, topic, partition) keys from registration on: one
that registers them later takes them over, and the commit of the earlier one
fails (``FencedError``).

Controllers mirror the reference: a single partition (D1), a topic (D2) or a
set of topics (D3). ``Runner`` runs several processors at once, one driver
thread each, all submitting jobs to the same session.
"""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import accounting as acc
from loglake.operators.scan import range_scan
from loglake.plans.throttle import plan_group, plan_partition, plan_topic
from loglake.schema import WATER
from loglake.session import delete_path, file_system, path_exists, read_text, write_text
from loglake.sources.log import LogTable
from loglake.sources.offsets import OffsetStore

logger = logging.getLogger(__name__)

DEFAULT_MAX_QUEUE = 5000
IDLE_SLEEP_SEC = 0.1
SNAPSHOT_EVERY = 100  # commits of a processor between compactions of the store


class DataLossError(RuntimeError):
    """A position lies outside the log's bounds: messages were lost, or the log was cut."""


# --- controllers ----------------------------------------------------------------


@dataclass
class Controller:
    entries: list[tuple[str, str, int]]  # (group, topic, max_queue)
    rule: str = "topic"
    partition: int | None = None

    @property
    def topics(self) -> list[str]:
        return sorted({t for _, t, _ in self.entries})

    @property
    def groups(self) -> list[str]:
        return sorted({g for g, _, _ in self.entries})

    def registrations(self, spark: SparkSession) -> DataFrame:
        return acc.registrations(spark, self.entries)

    def restrict(self, positions: DataFrame) -> DataFrame:
        if self.partition is None:
            return positions
        return positions.filter(F.col("partition") == self.partition)

    def plan(self, positions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        positions = self.restrict(positions)
        if self.rule == "partition":
            return plan_partition(positions, keep=keep)
        if self.rule == "group":
            return plan_group(positions, keep=keep)
        return plan_topic(positions, keep=keep)


def PartitionController(group: str, topic: str, partition: int, max_queue: int = DEFAULT_MAX_QUEUE) -> Controller:
    return Controller([(group, topic, max_queue)], rule="partition", partition=partition)


def TopicController(group: str, topic: str, max_queue: int = DEFAULT_MAX_QUEUE) -> Controller:
    return Controller([(group, topic, max_queue)], rule="topic")


def TopicSetController(entries: list[tuple[str, str] | tuple[str, str, int]]) -> Controller:
    full = [(e[0], e[1], int(e[2]) if len(e) > 2 else DEFAULT_MAX_QUEUE) for e in entries]
    if len({(g, t) for g, t, _ in full}) != len(full):
        raise ValueError("a (group, topic) pair is registered twice")
    return Controller(full, rule="group")


# --- gate -------------------------------------------------------------------------


@dataclass
class GateState:
    lag: int
    batch_id: int
    since_last_batch: float
    positions: list[Row] = field(default_factory=list)


def lag_at_least(threshold: int) -> Callable[[GateState], bool]:
    """Process only when the backlog is at least ``threshold`` (bucket full)."""
    return lambda s: s.lag >= threshold


def every(seconds: float) -> Callable[[GateState], bool]:
    """Process at most once per ``seconds`` (time-triggered)."""
    return lambda s: s.since_last_batch >= seconds


# --- processor ----------------------------------------------------------------------

_POSITIONS = (
    "group_id string, topic string, partition int, max_queue int, earliest bigint, latest bigint, "
    "stored bigint, position bigint, status string, parts bigint, topic_lag bigint"
)
_POSITION_NAMES = [c.split()[0] for c in _POSITIONS.split(", ")]


class Processor:
    """Fetch -> process -> commit loop over one controller.

    Like the reference, stored positions are read once, at registration
    (start resolution, E1); afterwards the loop keeps each partition's
    position in memory and advances it on commit. Every round refreshes only
    the bounds. Processors of one group on different topics may share a store:
    positions and their sequence numbers belong to (group, topic, partition)."""

    def __init__(
        self,
        log: LogTable | DataFrame | Callable[[], LogTable | DataFrame],
        store: OffsetStore,
        controller: Controller,
        process: Callable[[DataFrame, int], None],
        gate: Callable[[GateState], bool] | None = None,
        on_stopped: Callable[[], None] | None = None,
        wal_root: str | None = None,
        reset: str = "latest",
        zero_is_missing: bool = True,
        fail_on_data_loss: bool = True,
        persist: bool = True,
        idle_sleep: float = IDLE_SLEEP_SEC,
        name: str | None = None,
        snapshot_every: int | None = SNAPSHOT_EVERY,
    ):
        self._log = log
        self.store = store
        self.spark = store.spark
        self.controller = controller
        self.process = process
        self.gate = gate
        self.on_stopped = on_stopped
        self.wal_root = wal_root.rstrip("/") if wal_root else None
        self.reset = reset
        self.zero_is_missing = zero_is_missing
        self.fail_on_data_loss = fail_on_data_loss
        self.persist = persist
        self.idle_sleep = idle_sleep
        self.snapshot_every = snapshot_every
        self.name = name or "-".join(controller.groups)
        self._stop = threading.Event()
        self._registered = False
        self._next_batch: int | None = None
        self._last_batch_end = time.time()
        self._pos: dict[tuple[str, str, int], dict] = {}
        self._seq: dict[tuple[str, str, int], int] = {}
        self._epochs: dict[tuple[str, str, int], int] = {}
        self._owner = f"{self.name}-{uuid.uuid4().hex[:8]}"
        self._commits = 0
        self.batches: list[int] = []
        self.progress: list[dict] = []  # one entry per processed batch, like a streaming query's progress
        self._plan_sec = 0.0

    # -- inputs ---------------------------------------------------------------
    def source(self) -> LogTable | DataFrame:
        return self._log() if callable(self._log) else self._log

    def water(self) -> DataFrame:
        """Bounds of the controller's topics: from the records of a
        ``LogTable``, else an aggregate over the ``offset`` column."""
        src = self.source()
        if isinstance(src, LogTable):
            return src.bounds(self.controller.topics)
        return acc.watermarks(src.filter(F.col("topic").isin(*self.controller.topics)))

    def _ends(self) -> dict[tuple[str, int], tuple[int, int]]:
        """The same on the driver, of a ``LogTable`` without a job."""
        src = self.source()
        if isinstance(src, LogTable):
            return src.ends(self.controller.topics)
        return {(r["topic"], r["partition"]): (r["earliest"], r["latest"]) for r in self.water().collect()}

    def _claim(self, keys: list[tuple[str, str, int]]) -> None:
        self._epochs |= self.store.claim(keys, self._owner)
        for k, (_, seq) in self.store.current().items():
            if k in keys:
                self._seq[k] = seq

    def _store(self, moved: list[tuple[str, str, int, int]], commit: str | None = None) -> None:
        """Store (group, topic, partition, position) rows as one commit, each
        after the last sequence number of its own key."""
        if not moved:
            return
        rows = [(g, t, p, o, self._seq.get((g, t, p), 0) + 1) for g, t, p, o in moved]
        self.store.append(rows, commit, self._epochs)
        for g, t, p, _, seq in rows:
            self._seq[(g, t, p)] = seq
        self._commits += 1
        if self.snapshot_every and self._commits % self.snapshot_every == 0:
            self.store.compact()

    def register(self) -> None:
        """Resolve start positions (E1) from the store and store the moved
        ones at once; unknown topics are an error. A partition without a
        position of a topic that the group has positions in came after the
        group's first registration: it starts at its earliest offset."""
        ends = {k: e for k, e in self._ends().items() if self.controller.partition in (None, k[1])}
        known = {t for t, _ in ends}
        missing = [t for t in self.controller.topics if t not in known]
        if missing:
            raise ValueError(f"topic(s) not found: {missing}")
        for (t, p), (earliest, latest) in ends.items():
            if earliest < 0 or latest < 0:  # E2, before anything is stored
                raise acc.UnstableSourceError(f"negative bounds for {t}[{p}]")
        # from here on no earlier owner can store a position of these keys
        self._claim([(g, t, p) for g, t, _ in self.controller.entries for u, p in ends if u == t])
        regs = self.controller.registrations(self.spark)
        stored = {}
        for g in self.controller.groups:
            stored |= self.store.current(g)
        water = pd.DataFrame([(t, p, a, z) for (t, p), (a, z) in ends.items()], columns=["topic", "partition", "earliest", "latest"])
        rows = acc.resolve_start(
            self.spark.createDataFrame(water, WATER), regs, self.store.read(), self.zero_is_missing, self.reset
        ).collect()
        followed = {(g, t) for g, t, _ in stored}
        moved = []
        for r in rows:
            key = (r["group_id"], r["topic"], r["partition"])
            position = int(r["position"])
            if key not in stored and key[:2] in followed and self.controller.partition is None:
                position = int(r["earliest"])
            self._pos[key] = {"max_queue": r["max_queue"], "position": position}
            if position != (r["stored"] or 0):
                moved.append((*key, position))
        self._store(moved)
        self._registered = True

    def _bounds(self) -> list[Row]:
        """In-memory positions against fresh bounds, P rows on the driver. A
        partition that appeared after registration starts at its earliest
        offset. A position outside the bounds, or a partition that left them,
        is data loss: an error, or with ``fail_on_data_loss=False`` the
        position moves to the nearer bound and is stored."""
        water = self._ends()
        for (t, p), (earliest, latest) in water.items():
            if earliest < 0 or latest < 0:  # E2: refuse an unstable source
                raise acc.UnstableSourceError(f"negative bounds for {t}[{p}]: {earliest}..{latest}")
        rows, moved, new = [], [], []
        for g, t, q in self.controller.entries:
            for (topic, p), (earliest, _) in water.items():
                if topic == t and (g, t, p) not in self._pos and self.controller.partition in (None, p):
                    self._pos[(g, t, p)] = {"max_queue": q, "position": int(earliest)}
                    new.append((g, t, p))
                    if earliest > 0:  # a stored 0 would read as none
                        moved.append((g, t, p, int(earliest)))
        self._claim(new)
        for (g, t, p), st in sorted(self._pos.items()):
            w = water.get((t, p))
            if w is None:
                if self.fail_on_data_loss:
                    raise DataLossError(f"{g} {t}[{p}] at {st['position']} is gone from the log")
                continue
            earliest, latest, stored = int(w[0]), int(w[1]), st["position"]
            position, status = min(max(stored, earliest), latest), "valid"
            if position != stored:
                if self.fail_on_data_loss:
                    raise DataLossError(f"{g} {t}[{p}] at {stored} lies outside {earliest}..{latest}")
                status = "below" if stored < earliest else "above"
                st["position"] = position
                moved.append((g, t, p, position))
            rows.append((g, t, p, st["max_queue"], earliest, latest, stored, position, status))
        self._store(moved)
        # per-topic partition count and lag (sums over the P rows) for the rule
        parts: dict[tuple[str, str], int] = {}
        lag: dict[tuple[str, str], int] = {}
        for r in rows:
            parts[(r[0], r[1])] = parts.get((r[0], r[1]), 0) + 1
            lag[(r[0], r[1])] = lag.get((r[0], r[1]), 0) + (r[5] - r[7])
        return [(*r, parts[(r[0], r[1])], lag[(r[0], r[1])]) for r in rows]

    def _planned(self) -> list[Row]:
        """The controller's rule over the current positions (a DataFrame of P
        local rows): PLAN rows plus earliest, latest, stored, position and
        status."""
        # from pandas: a LocalRelation, so the rule (a projection) runs on the driver without tasks
        positions = self.spark.createDataFrame(pd.DataFrame(self._bounds(), columns=_POSITION_NAMES), _POSITIONS)
        keep = ("earliest", "latest", "stored", "position", "status")
        rows = self.controller.plan(positions, keep=keep).collect()
        return sorted(rows, key=lambda r: (r["group_id"], r["topic"], r["partition"]))

    # -- write-ahead plans (small JSON files that appear whole; the last few are kept) ---------
    def _wal_ids(self) -> list[int]:
        if not self.wal_root or not path_exists(self.spark, self.wal_root):
            return []
        fs, root = file_system(self.spark, self.wal_root)
        ids = []
        for st in fs.listStatus(root):
            n = st.getPath().getName()
            if n.startswith("batch_id=") and n.endswith(".json"):
                ids.append(int(n[len("batch_id="):-len(".json")]))
        return sorted(ids)

    def _wal_path(self, batch_id: int) -> str:
        return f"{self.wal_root}/batch_id={batch_id}.json"

    def _read_wal(self, batch_id: int) -> tuple[list[Row], str, dict[tuple[str, str, int], int]]:
        """(plan rows, id of the commit that the batch makes, sequence number that it stores for each moved key)."""
        d = json.loads(read_text(self.spark, self._wal_path(batch_id)))
        return [Row(**r) for r in d["plan"]], d["commit"], {(g, t, p): seq for g, t, p, seq in d["stores"]}

    def _write_wal(self, batch_id: int, rows: list[Row], commit: str) -> None:
        names = ("group_id", "topic", "partition", "start_offset", "stop_offset")
        stores = [[g, t, p, self._seq.get((g, t, p), 0) + 1] for g, t, p, _ in self._moved(rows)]
        write_text(self.spark, self._wal_path(batch_id), json.dumps({"commit": commit, "stores": stores, "plan": [{n: r[n] for n in names} for r in rows]}))

    @staticmethod
    def _moved(rows: list[Row]) -> list[tuple[str, str, int, int]]:
        """E3/E5/N7: only moved partitions, never a stop <= 0."""
        return [
            (r["group_id"], r["topic"], int(r["partition"]), int(r["stop_offset"]))
            for r in rows
            if r["stop_offset"] != r["start_offset"] and r["stop_offset"] > 0
        ]

    # -- loop ---------------------------------------------------------------------
    def lag(self) -> int:
        if not self._registered:
            self.register()
        return sum(max(0, r[5] - r[7]) for r in self._bounds())

    def stop(self) -> None:
        """Stop after the current batch."""
        self._stop.set()

    def _run_batch(self, batch_id: int, rows: list[Row], commit: str | None) -> None:
        t0 = time.perf_counter()
        data = range_scan(self.source(), rows)
        if self.persist:
            data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.process(data, batch_id)
        finally:
            if self.persist:
                data.unpersist()
        t1 = time.perf_counter()
        moved = self._moved(rows)
        self._store(moved, commit)
        for g, t, p, stop in moved:
            if (g, t, p) in self._pos:
                self._pos[(g, t, p)]["position"] = stop
        if self.wal_root and batch_id > 0:  # its commit is there: older plans are never replayed
            delete_path(self.spark, self._wal_path(batch_id - 1))
        self.batches.append(batch_id)
        self.progress.append(
            {
                "batch_id": batch_id,
                "ranges": sum(1 for r in rows if r["stop_offset"] > r["start_offset"]),
                "offsets": sum(int(r["stop_offset"]) - int(r["start_offset"]) for r in rows),
                "plan_sec": round(self._plan_sec, 4),
                "process_sec": round(t1 - t0, 4),
                "commit_sec": round(time.perf_counter() - t1, 4),
            }
        )
        self._plan_sec = 0.0
        self._next_batch = batch_id + 1
        self._last_batch_end = time.time()

    def _resume(self) -> bool:
        """Take up the last write-ahead plan: True if its batch was replayed. It is replayed exactly as planned if no
        commit of its keys has come since. If one of each key has, the batch is done; if only of some (positions were set
        by hand), the plan is void and its batch id is planned again."""
        ids = self._wal_ids()
        self._next_batch = ids[-1] + 1 if ids else 0
        if not ids:
            return False
        plan, commit, stores = self._read_wal(ids[-1])
        now = self.store.current()
        later = [k for k, seq in stores.items() if now.get(k, (0, 0))[1] >= seq]
        if not stores or len(later) == len(stores):
            return False
        if later:
            self._next_batch = ids[-1]
            return False
        self._check_there(plan)
        self._claim(list(stores))
        self._run_batch(ids[-1], plan, commit)
        return True

    def _check_there(self, plan: list[Row]) -> None:
        """The planned ranges must still lie in the log's bounds."""
        ends = self._ends()
        for r in plan:
            if r["stop_offset"] > r["start_offset"]:
                earliest, latest = ends.get((r["topic"], r["partition"]), (0, -1))
                if r["start_offset"] < earliest or r["stop_offset"] > latest:
                    what = f"planned {r['start_offset']}..{r['stop_offset']} of {r['topic']}[{r['partition']}], the log has {earliest}..{latest}"
                    if self.fail_on_data_loss:
                        raise DataLossError(what)
                    logger.warning("%s: the rest is lost", what)

    def step(self) -> bool:
        """One iteration; True if a batch was processed. A write-ahead plan
        left without its commit is replayed first, before registration, so
        start resolution sees its commit."""
        if self._next_batch is None and self._resume():
            return True
        if not self._registered:
            self.register()
        t0 = time.perf_counter()
        plan = self._planned()
        self._plan_sec = time.perf_counter() - t0
        lag = sum(max(0, r["latest"] - r["position"]) for r in plan)
        if lag <= 0:
            return False
        state = GateState(lag, self._next_batch, time.time() - self._last_batch_end, plan)
        if self.gate is not None and not self.gate(state):
            return False
        if not any(r["stop_offset"] > r["start_offset"] for r in plan):
            return False
        commit = uuid.uuid4().hex
        if self.wal_root:
            self._write_wal(self._next_batch, plan, commit)
        self._run_batch(self._next_batch, plan, commit)
        return True

    def run(self, stop_when_idle: bool = False, max_batches: int | None = None) -> int:
        """Loop until stopped (or, with ``stop_when_idle``, until there is no
        lag or the gate declines). Returns the number of batches processed.
        The stop hook runs on every exit, also when ``process`` raises; a
        failed batch is not committed."""
        done = 0
        try:
            while not self._stop.is_set():
                if self.step():
                    done += 1
                    if max_batches is not None and done >= max_batches:
                        break
                elif stop_when_idle:
                    break
                else:
                    time.sleep(self.idle_sleep)
        finally:
            self._stop.clear()
            if self.on_stopped is not None:
                self.on_stopped()
        return done


# --- several processors -------------------------------------------------------------


class Runner:
    """Run processors concurrently, one driver thread each (the reference's
    ProcessorRunner). ``start`` returns when all have ended and re-raises the
    first failure. With ``pools=True`` each processor submits its jobs to its
    own FAIR scheduler pool."""

    def __init__(self, processors: list[Processor] | None = None, pools: bool = False):
        self.processors: list[Processor] = list(processors or [])
        self.pools = pools

    def add(self, p: Processor) -> Runner:
        self.processors.append(p)
        return self

    def stop(self) -> None:
        for p in self.processors:
            p.stop()

    def start(self, **run_kwargs) -> dict[str, int]:
        from pyspark import inheritable_thread_target

        results: dict[str, int] = {}
        errors: list[BaseException] = []

        def body(p: Processor):
            try:
                if self.pools:
                    p.spark.sparkContext.setLocalProperty("spark.scheduler.pool", p.name)
                results[p.name] = p.run(**run_kwargs)
            except BaseException as e:  # noqa: BLE001 - reported to the caller
                errors.append(e)
                self.stop()

        threads = []
        for p in self.processors:
            target = inheritable_thread_target(p.spark)(body)
            threads.append(threading.Thread(target=target, args=(p,), name=p.name))
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if errors:
            raise errors[0]
        return results
