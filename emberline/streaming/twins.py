"""Streaming twins of the batch steps. Each takes and gives a streaming DataFrame; all but first_seen and
candidate_timers take a batch one too."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import params as P

LATE = "5 days"


def first_seen(det: DataFrame, key: list[str], late: str = LATE) -> DataFrame:
    """Of repeated detections the first that arrives; later copies within the watermark are dropped."""
    return det.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def pass_sessions(det: DataFrame, late: str = LATE) -> DataFrame:
    """Passes as session windows: a gap of more than PASS_GAP_MINUTES ends one; its end is the last detection's time."""
    window = F.session_window("ts", f"{P.PASS_GAP_MINUTES} minutes")
    s = det.withWatermark("ts", late).groupBy("satellite", "instrument", window).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"))
    return s.drop("session_window")


def class_counts(det: DataFrame, every: str = "6 hours", late: str = LATE) -> DataFrame:
    """Detections and power per satellite in tumbling windows."""
    w = det.withWatermark("ts", late).groupBy(F.window("ts", every), "satellite").agg(F.count("*").alias("n"), F.sum("frp").alias("power"))
    return w.select(F.col("window.start").alias("start"), "satellite", "n", "power")


def past_confirmed(det: DataFrame, late: str = "90 minutes") -> DataFrame:
    """Pairs of a detection and an earlier one within TEMPORAL_MINUTES and the widest radius: an interval self-join whose
    state is bounded by the watermark. Cells make it an equi-join; the exact radius is the left instrument's."""
    from ..functions.classify import by_instrument

    widest = max(P.TEMPORAL_RADIUS.values())
    cell = lambda c: F.floor(F.col(c) / widest)
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    new = det.withWatermark("ts", late).withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).withColumn("cx", cell("x") + F.col("dx")).withColumn("cy", cell("y") + F.col("dy"))
    old = det.select(F.col("id").alias("old_id"), F.col("ts").alias("old_ts"), F.col("x").alias("old_x"), F.col("y").alias("old_y"), cell("x").alias("cx"), cell("y").alias("cy")).withWatermark("old_ts", late)
    span = (F.col("old_ts") < F.col("ts")) & (F.col("old_ts") >= F.col("ts") - F.expr(f"INTERVAL {P.TEMPORAL_MINUTES} MINUTES"))
    x, y, r = F.col("x") - F.col("old_x"), F.col("y") - F.col("old_y"), by_instrument(P.TEMPORAL_RADIUS)
    return new.join(old, (new["cx"] == old["cx"]) & (new["cy"] == old["cy"]) & span).filter(x * x + y * y <= r * r).select("id", "old_id", "ts")


def recency_windows(det: DataFrame, length: str = "48 hours", every: str = "6 hours", late: str = LATE) -> DataFrame:
    """Detections and power per satellite in sliding windows: the recent state as of each step."""
    w = det.withWatermark("ts", late).groupBy(F.window("ts", length, every), "satellite").agg(F.count("*").alias("n"), F.sum("frp").alias("power"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "satellite", "n", "power")


def anchored_counts(det: DataFrame, anchor: str, every: str = "6 hours", late: str = LATE) -> DataFrame:
    """Counts in windows that begin with the first state's time, as the snapshots do; anchor: how far that lies after a
    full step since 1970, such as "90 minutes"."""
    w = det.withWatermark("ts", late).groupBy(F.window("ts", every, every, anchor), "satellite").agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), "satellite", "n")


def robust_evidence(smoothed: DataFrame, frozen: float) -> DataFrame:
    """Evidence against a maximum that is held fixed: the batch model takes the whole run's, which no stream can know, and a
    later pass would change what earlier ones were compared with. smoothed: p, r, c, v with p's maximum as pmax."""
    limit = F.greatest(F.lit(P.EVIDENCE_ABSOLUTE), F.col("pmax") / frozen * P.EVIDENCE_RELATIVE)
    return smoothed.filter(F.col("v") / frozen >= limit)


def append_archive(path: str, key: list[str]):
    """A foreachBatch function: rows are added to the archive at path, a folder for each batch, and nothing is ever taken
    away. A batch that is repeated after a failure replaces its own folder."""

    def add(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(key).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return add


def archive_view(archive: DataFrame, key: list[str], best: str = "frp") -> DataFrame:
    """Of each key the row with the highest best, over all batches, the earliest batch's of equal ones."""
    rest = [c for c in archive.columns if c not in key and c != "batch"]
    row = F.max_by(F.struct(*rest), F.struct(F.col(best), -F.col("batch")))
    return archive.groupBy(*key).agg(row.alias("row")).select(*key, "row.*")


CANDIDATES = "region long, candidate long, ts timestamp, outcome string"


def _candidates(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State: (number, epoch seconds, row, column) of each candidate that waits."""
    waiting = [tuple(x) for x in state.get[0]] if state.exists else []
    hours, reach = P.CONFIRM_HOURS * 3600, P.CONFIRM_CELLS**2
    rows = []
    if not state.hasTimedOut:
        new = pd.concat(batches).sort_values(["ts", "candidate"])
        for c in new.itertuples(index=False):
            now = c.ts.timestamp()
            late = [w for w in waiting if now - w[1] > hours]
            rows += [(key[0], w[0], pd.Timestamp(w[1] + hours, unit="s"), "expired") for w in late]
            waiting = [w for w in waiting if now - w[1] <= hours]
            near = [((w[2] - c.r) ** 2 + (w[3] - c.c) ** 2, i) for i, w in enumerate(waiting) if now > w[1]]
            best = min(near, default=None)
            if best and best[0] <= reach:
                met = waiting.pop(best[1])
                rows += [(key[0], met[0], c.ts, "confirmed"), (key[0], c.candidate, c.ts, "confirmed")]
            else:
                waiting.append((int(c.candidate), now, int(c.r), int(c.c)))
    else:
        now = state.getCurrentWatermarkMs() / 1000
        rows += [(key[0], w[0], pd.Timestamp(w[1] + hours, unit="s"), "expired") for w in waiting if now - w[1] > hours]
        waiting = [w for w in waiting if now - w[1] <= hours]
    if waiting:
        state.update((waiting,))
        state.setTimeoutTimestamp(max(int((min(w[1] for w in waiting) + hours) * 1000) + 1, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(rows, columns=["region", "candidate", "ts", "outcome"])


def candidate_timers(starts: DataFrame, late: str = "90 minutes") -> DataFrame:
    """What becomes of provisional starts: confirmed with the nearest earlier one that waits within CONFIRM_CELLS, or expired
    when CONFIRM_HOURS have passed, by event-time timers. starts: region, candidate, ts, r, c (a start's middle cell).

    State holds the waiting starts of a region, which the timers bound."""
    kind = "waiting array<struct<candidate: long, at: double, r: long, c: long>>"
    return starts.withWatermark("ts", late).groupBy("region").applyInPandasWithState(_candidates, CANDIDATES, kind, "append", GroupStateTimeout.EventTimeTimeout)
