"""The operators on Structured Streaming.

Row-wise operators (augmentation, screening) are the batch expressions on a stream. Ordered ones (metric tracker, trial gate) keep one small value per series in Spark's state
store: rows are packed by cells of consecutive positions where they are read, and ``transformWithStateInPandas`` updates each series that a micro-batch touches once, from
its packed cells. What a series was before goes on, beside the rows themselves, to the batch operator, which decides the rows of the micro-batch cell by cell, so a hot series is spread over tasks like in a
batch run. A micro-batch that is run again after a failure starts from the same version of the state and replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators import metrics as M
from ..operators import trials as H
from ..operators.safety import DEFAULT_THRESHOLD, pii_findings
from ..plans.lookup import salted_lookup

# -- output of micro-batches, state of series --------------------------------------------------

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Positions of a cell; within a task a series takes two bits for each position of the cells it has rows in.
CELL = 4096


class BatchStore:
    """Output tables under one folder, one part per micro-batch: ``<table>/batch=<id>``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def part(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def write(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self.part(name, batch))
        return self.spark.read.schema(df.schema).parquet(self.part(name, batch))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("batch")


def _run(stream: DataFrame, path: str, step: Callable[[DataFrame, int], None], available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(step).outputMode("update").option("checkpointLocation", f"{path}/checkpoint")
    return (w.trigger(availableNow=True) if available_now else w).start()


def state_of(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """The state of all series after a micro-batch, the last one by default: the key and the columns of the state."""
    reader = spark.read.format("statestore").option("stateVarName", "series")
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(f"{path}/checkpoint").select("key.*", "value.*")


def packed(rows: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """One row per series and cell of each Arrow batch: ``key``, ``cell``, the sorted positions ``at`` and an array of doubles for each value (null: NaN)."""
    kind = dict(rows.dtypes)[key]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.assign(cell=pdf[order] // CELL).sort_values(order, kind="stable")
            groups = pdf.groupby([key, "cell"], sort=False, dropna=False)
            out = groups.agg(at=(order, list), **{v: (v, list) for v in values}).reset_index()
            yield out[[key, "cell", "at", *values]]

    columns = ", ".join(f"`{v}` array<double>" for v in values)
    return rows.select(key, order, *values).mapInPandas(pack, f"`{key}` {kind}, cell bigint, at array<bigint>, {columns}")


def with_carry(rows: DataFrame, pieces: DataFrame, key: str, processor: StatefulProcessor, carry: str) -> DataFrame:
    """A stream of two kinds of rows: those of the micro-batch (``row``) and, for each series among them, what its state was before (``carry``)."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    before = pieces.groupBy(key).transformWithStateInPandas(processor, outputStructType=carry, outputMode="Update", timeMode="None")
    none = F.lit(None)
    row, state = F.struct(*rows.columns), F.struct(*before.columns)
    return rows.select(row.alias("row"), none.cast(before.select(state).schema[0].dataType).alias("carry")).unionByName(
        before.select(none.cast(rows.select(row).schema[0].dataType).alias("row"), state.alias("carry"))
    )


def _split_late(store: BatchStore, batch: DataFrame, i: int, key: str, order: str, once: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The rows of a micro-batch, marked where they are at or before the last position of their series, and the states before it.

    The micro-batch is written as it comes, so that its state is computed once.
    """
    both = store.write(batch, "arrived", i)
    carry = both.filter("carry IS NOT NULL").select("carry.*")
    rows = once(both.filter("row IS NOT NULL").select("row.*"))
    rows = salted_lookup(rows, carry.select(key, "s_last"), [key], [order])
    rows = store.write(rows.withColumn("_late", F.coalesce(F.col(order) <= F.col("s_last"), F.lit(False))).drop("s_last"), "input", i)
    store.write(rows.filter("_late").drop("_late"), "late", i)
    return rows.filter("NOT _late").drop("_late"), carry.filter("s_last IS NOT NULL")


class _Cells:
    """Positions seen, by cell: distinct counts without a list of positions."""

    def __init__(self) -> None:
        self.bits: dict[int, np.ndarray] = {}

    def add(self, cell: int, at: np.ndarray) -> None:
        self.bits.setdefault(cell, np.zeros(CELL, bool))[at - cell * CELL] = True

    def has(self, at: int) -> bool:
        cell = at // CELL
        return cell in self.bits and bool(self.bits[cell][at - cell * CELL])

    def close(self) -> None:
        self.order = sorted(self.bits)
        self.total = np.concatenate([[0], np.cumsum([int(self.bits[c].sum()) for c in self.order])])

    def up_to(self, at: int) -> int:
        """How many positions are at or before this one (which has been added)."""
        cell = at // CELL
        return int(self.total[self.order.index(cell)]) + int(self.bits[cell][: at - cell * CELL + 1].sum())


# -- metric tracker -----------------------------------------------------------------------

TRACKER_STATE = "s_last bigint, s_n bigint, s_best double, s_best_step bigint, s_stuck boolean, s_tail_steps array<bigint>, s_tail array<double>"


class TrackerState(StatefulProcessor):
    """Last step, number of values, best value and its step, whether the series began with NaN, and the last values."""

    def __init__(self, sign: int, window: int):
        self.sign, self.window = sign, window

    def init(self, handle) -> None:
        self.series = handle.getValueState("series", TRACKER_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.series.get() if self.series.exists() else None
        last, n, best, best_step, stuck, steps, tail = old or (None, 0, None, None, None, [], [])
        seen, top, own, first = _Cells(), last, [], None
        if best is not None and not stuck:
            own.append((best * self.sign, best_step))
        ends = dict(zip(steps, [v * self.sign for v in tail]))
        for pdf in rows:
            for cell, at, value in zip(pdf["cell"], pdf["at"], pdf["value"]):
                at, value = np.asarray(at, np.int64), np.asarray(value, np.float64) * self.sign
                if last is not None:
                    at, value = at[at > last], value[at > last]
                if not len(at):
                    continue
                seen.add(int(cell), at)
                top = int(at[-1]) if top is None else max(top, int(at[-1]))
                real = np.flatnonzero(~np.isnan(value))
                if len(real):
                    k = real[np.argmin(value[real])]
                    own = [min([*own, (float(value[k]), int(at[k]))])]
                began = at == at[0]
                start = (int(at[0]), bool(np.isnan(value[began]).all()))
                first = start if first is None or start < first else first
                # of values at one step the best counts, NaN only without another
                for s, v in zip(at[-4 * self.window :].tolist(), value[-4 * self.window :].tolist()):
                    ends[s] = v if s not in ends or np.isnan(ends[s]) or v < ends[s] else ends[s]
                ends = {s: ends[s] for s in sorted(ends)[-self.window :]}
        seen.close()
        if stuck is None and first is not None:
            stuck = first[1]
        if stuck:
            new_best, new_step = float("nan"), best_step if best_step is not None else first and first[0]
        else:
            new_best, new_step = (own[0][0] * self.sign, own[0][1]) if own else (None, None)
        if top != last:
            order = sorted(ends)
            self.series.update((top, n + int(seen.total[-1]), new_best, new_step, stuck, order, [ends[s] * self.sign for s in order]))
        yield pd.DataFrame({"run": [key[0]], "s_last": pd.array([last], "Int64"), "best": [best], "stuck": pd.array([None if old is None else old[4]], "boolean")})

    def close(self) -> None:
        pass


def stream_metric_tracker(
    stream: DataFrame, path: str, direction: str = "minimize", window: int = 10, available_now: bool = True
) -> StreamingQuery:
    """Tracks series (run, step, value): table ``flags`` says of every value whether it improved,
    table ``late`` holds values at or before a step already passed, and ``tracker_summary`` reads the state.

    Of several values at one step of a micro-batch the best counts, NaN only if there is no other; a null counts as NaN."""
    sign = 1 if direction == "minimize" else -1
    store = BatchStore(stream.sparkSession, path)
    nan = F.lit(float("nan"))
    rows = stream.select("run", "step", F.coalesce(F.col("value").cast("double"), nan).alias("value"))

    def once(df: DataFrame) -> DataFrame:
        real = F.when(~F.isnan("value"), F.col("value") * sign)
        return df.groupBy("run", "step").agg(F.coalesce(F.min(real) * sign, nan).alias("value"))

    def step(batch: DataFrame, i: int) -> None:
        fresh, before = _split_late(store, batch, i, "run", "step", once)
        store.write(M.improved(fresh, ("run",), direction=direction, carry=before.select("run", "best", "stuck")), "flags", i)

    pieces = packed(rows, "run", "step", ["value"])
    carry = "run string, s_last bigint, best double, stuck boolean"
    return _run(with_carry(rows, pieces, "run", TrackerState(sign, window), carry), path, step, available_now)


def tracker_flags(spark: SparkSession, path: str) -> DataFrame:
    return BatchStore(spark, path).read("flags")


def tracker_summary(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """latest, best, best_step, avg_last_10 and n_values per series after a micro-batch, the last one by default."""
    s = state_of(spark, path, batch)
    mean = F.aggregate("s_tail", F.lit(0.0), lambda a, v: a + v) / F.size("s_tail")
    return s.select(
        "run", F.element_at("s_tail", -1).alias("latest"), F.col("s_best").alias("best"), F.col("s_best_step").alias("best_step"),
        mean.alias("avg_last_10"), F.col("s_n").alias("n_values"),
    )


# -- trial gate ---------------------------------------------------------------------------

GATE_STATE = "s_last bigint, best double, fails bigint, stopped boolean"


class GateState(StatefulProcessor):
    """Last trial, best value, rejections since the last acceptance, and whether the experiment was given up.

    Only trials that are better than all before them in their piece can move the best value; they, and those judged by a value under its short name, are taken in order.
    All others just count, as bits of their cells.
    """

    def __init__(self, sign: int, threshold: float, patience: int):
        self.sign, self.threshold, self.patience = sign, threshold, patience

    def init(self, handle) -> None:
        self.series = handle.getValueState("series", GATE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.series.get() if self.series.exists() else (None, None, 0, False)
        last, best, fails, stopped = old
        counted, owned, base = _Cells(), _Cells(), None
        moves: list[tuple[int, float]] = []
        shorts: list[tuple[int, float]] = []
        for pdf in rows:
            for cell, at, own, short, given, has in zip(pdf["cell"], pdf["at"], pdf["own"], pdf["short"], pdf["base"], pdf["kinds"]):
                at, own, short, given, has = (np.asarray(x) for x in (at, own, short, given, has))
                at = at.astype(np.int64)
                base = float(given[0]) if base is None and not np.isnan(given[0]) else base
                fresh = at > last if last is not None else np.ones(len(at), bool)
                if not fresh.any():
                    continue
                counted.add(int(cell), at[fresh])
                mine = fresh & (has == 1)
                owned.add(int(cell), at[mine])
                ids, values = at[mine], own[mine]
                if len(ids):
                    order = np.lexsort((values, ids))
                    ids, values = ids[order], values[order]
                    low = np.fmin.accumulate(values)
                    record = np.concatenate([[True], (values[1:] < low[:-1]) | np.isnan(low[:-1])])
                    take = record if self.threshold > 0 else np.ones(len(ids), bool)
                    moves += zip(ids[take].tolist(), values[take].tolist())
                other = fresh & (has == 2)
                shorts += zip(at[other].tolist(), short[other].tolist())
        counted.close()
        ref = best * self.sign if best is not None else (base * self.sign if base is not None else None)
        moved, hits, done = best, [], set()
        todo = sorted([(a, v, True) for a, v in moves] + [(a, v, False) for a, v in shorts if not owned.has(a)])
        for a, v, moving in todo:
            if a in done:
                continue
            done.add(a)
            if ref is None or (0.0 if ref == 0 else (ref - v) / abs(ref)) >= self.threshold:
                hits.append(a)
                if moving:
                    moved, ref = v * self.sign, v
        total = int(counted.total[-1])
        if total:
            places = [counted.up_to(a) for a in hits]
            runs = [b - a - 1 for a, b in zip([-fails, *places], [*places, total + 1])] if places else [fails + total]
            stopped = stopped or any(r >= self.patience for r in runs)
            top = max(counted.order[-1] * CELL + int(np.flatnonzero(counted.bits[counted.order[-1]])[-1]), last if last is not None else -(1 << 63))
            self.series.update((top, moved, runs[-1], stopped))
        yield pd.DataFrame({"experiment": [key[0]], "s_last": pd.array([last], "Int64"), "best": [best], "fails": [fails], "stopped": [old[3]]})

    def close(self) -> None:
        pass


def stream_trial_gate(
    stream: DataFrame, path: str, baselines: DataFrame | None = None, patience: int = H.PATIENCE, available_now: bool = True,
    metric: str = H.METRIC, direction: str = "minimize", threshold: float = H.THRESHOLD,
) -> StreamingQuery:
    """Decides arriving trials (experiment, trial_id, ...): table ``decisions``, and ``late`` for
    trials at or before one already decided.

    Of rows with one trial_id in a micro-batch that with the best value counts; trials that raised ('exception') are left out."""
    store = BatchStore(stream.sparkSession, path)
    kind = dict(stream.dtypes)["experiment"]
    sign = 1 if direction == "minimize" else -1
    own, short = H.judged_values(stream, metric)
    own, short = own * sign, short * sign
    raised = H.raised(stream)

    def first_of(own: Column, short: Column) -> Column:
        return F.struct(own.isNull(), own, short.isNull(), short)

    def once(df: DataFrame) -> DataFrame:
        o, s = H.judged_values(df, metric)
        best = df.groupBy("experiment", "trial_id").agg(F.min_by(F.struct(*df.columns), first_of(o * sign, s * sign)).alias("r"))
        return best.select("r.*")

    rows = stream.withColumn("_raised", raised).filter("NOT _raised").drop("_raised")
    marked = rows.select("experiment", "trial_id", own.alias("own"), short.alias("short"))
    marked = marked.withColumn("kinds", F.when(F.col("own").isNotNull(), 1.0).when(F.col("short").isNotNull(), 2.0).otherwise(0.0))
    if baselines is None:
        marked = marked.withColumn("base", F.lit(None).cast("double"))
    else:
        marked = marked.join(baselines.select("experiment", F.col("baseline").cast("double").alias("base")), "experiment", "left")

    def step(batch: DataFrame, i: int) -> None:
        fresh, before = _split_late(store, batch, i, "experiment", "trial_id", once)
        rules = {"metric": metric, "direction": direction, "threshold": threshold}
        decided = H.sequential_gate(fresh, baselines=baselines, patience=patience, carry=before, **rules)
        keep = ["experiment", "trial_id", "primary_metric", "best", "accepted", "improvement", "reason", "fails", "ran"]
        store.write(decided.select(*keep), "decisions", i)

    pieces = packed(marked, "experiment", "trial_id", ["own", "short", "base", "kinds"])
    carry = f"experiment {kind}, s_last bigint, best double, fails bigint, stopped boolean"
    return _run(with_carry(rows, pieces, "experiment", GateState(sign, float(threshold), patience), carry), path, step, available_now)


def gate_decisions(spark: SparkSession, path: str) -> DataFrame:
    return BatchStore(spark, path).read("decisions")


# -- row-wise streams ---------------------------------------------------------------------


def _append(df: DataFrame, path: str, available_now: bool, by: Sequence[str] = ()) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/data")
    if by:
        w = w.partitionBy(*by)
    return (w.trigger(availableNow=True) if available_now else w).start()


def stream_augment(stream: DataFrame, augmenter, path: str, available_now: bool = True) -> StreamingQuery:
    """Augments arriving texts. Draws are keyed by the row, so a replay gives the same texts.
    A chain that looks words up runs on each micro-batch as a batch."""
    from ..operators.text_augment import needs_lookup

    if not needs_lookup(augmenter):
        return _append(augmenter.apply(stream), path, available_now)
    store = BatchStore(stream.sparkSession, path)
    return _run(stream, path, lambda batch, i: store.write(augmenter.apply(batch), "data", i), available_now)


def stream_safety(stream: DataFrame, path: str, text: str = "text", threshold: float = DEFAULT_THRESHOLD, available_now: bool = True) -> StreamingQuery:
    """Screens arriving texts into one table with the partitions 'clean' and 'quarantine', so that
    both parts of a micro-batch appear together."""
    found = stream.withColumn("findings", pii_findings(F.col(text), threshold))
    status = F.when(F.size("findings") == 0, "clean").otherwise("quarantine")
    return _append(found.withColumn("status", status), path, available_now, ["status"])


RUN_EVENT = (
    "run string, kind string, step bigint, metric string, value double, accepted boolean, reason string, at string"
)


def read_run_events(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines of running trials: 'metric' events and one 'end' event per run."""
    return spark.readStream.schema(RUN_EVENT).json(folder)


def stream_run_log(stream: DataFrame, path: str, available_now: bool = True) -> StreamingQuery:
    """Appends run events to a log partitioned by kind."""
    return _append(stream, path, available_now, ["kind"])


def run_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(metrics, runs): the logged values, and per run how it ended, or that it is open."""
    log = spark.read.schema(RUN_EVENT).parquet(f"{path}/data")
    metrics = log.filter("kind = 'metric'").select("run", "step", "metric", "value")
    ends = F.when(F.col("kind") == "end", F.struct("at", "accepted", "reason"))
    runs = log.groupBy("run").agg(F.max(ends).alias("e"), F.count_if(F.col("kind") == "metric").alias("points"))
    return metrics, runs.select(
        "run", F.col("e").isNotNull().alias("closed"), "e.accepted", "e.reason", F.col("e.at").alias("ended_at"), "points"
    )


# -- runs that are never ended ------------------------------------------------------------

RUN_STATE = "points bigint, last_ms bigint, closed boolean"


class RunEnds(StatefulProcessor):
    """Closes a run by its end event, or by a timer once the watermark has passed its last event by the time allowed."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.series = handle.getValueState("series", RUN_STATE)

    def _row(self, run, points, how, accepted, reason, at_ms) -> pd.DataFrame:
        at = pd.to_datetime([at_ms], unit="ms").tz_localize("UTC")
        return pd.DataFrame({"run": [run], "closed_by": [how], "accepted": pd.array([accepted], "boolean"), "reason": [reason], "ended_at": at, "points": [points]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        points, last, closed = self.series.get() if self.series.exists() else (0, None, False)
        if closed:
            return
        end = None
        for pdf in rows:
            ms = pdf["ts"].astype("datetime64[ms, UTC]" if pdf["ts"].dt.tz is not None else "datetime64[ms]").astype("int64")
            points += int((pdf["kind"] == "metric").sum())
            last = max(int(ms.max()), last if last is not None else int(ms.max()))
            for at, accepted, reason in zip(ms[pdf["kind"] == "end"], pdf["accepted"][pdf["kind"] == "end"], pdf["reason"][pdf["kind"] == "end"]):
                end = max(end, (int(at), reason, accepted)) if end else (int(at), reason, accepted)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.series.update((points, last, end is not None))
        if end:
            yield self._row(key[0], points, "end", bool(end[2]), end[1], end[0])
        else:
            self.handle.registerTimer(last + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        points, last, _ = self.series.get()
        self.series.update((points, last, True))
        yield self._row(key[0], points, "timeout", None, None, last + self.timeout_ms)

    def close(self) -> None:
        pass


def stream_run_ends(stream: DataFrame, path: str, timeout: str = "1 hour", watermark: str = "0 seconds", available_now: bool = True) -> StreamingQuery:
    """One row per closed run from events (run, kind, ts, accepted, reason): closed by its end event, or by a timer where none has come by the time the watermark
    passes its last event by ``timeout``. Events of a closed run are passed over; of several end events of one micro-batch the last one counts."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    ms = int(pd.Timedelta(timeout).total_seconds() * 1000)
    rows = stream.select("run", "kind", "ts", "accepted", "reason").withWatermark("ts", watermark)
    ends = rows.groupBy("run").transformWithStateInPandas(
        RunEnds(ms), outputStructType="run string, closed_by string, accepted boolean, reason string, ended_at timestamp, points bigint", outputMode="Append", timeMode="EventTime"
    )
    return _append(ends, path, available_now)
