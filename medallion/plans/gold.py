"""Silver to gold marts, from all of silver or from a state a day.

A mart's states are its partial sums per day of silver, grain and distinct column. They are merged exactly: distinct
counts are taken over the stored values. A day is computed again when its committed folders in silver are others than
those that its state was made from, so a refresh reads the days that changed and the states, not the history.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from medallion.operators import audit
from medallion.operators.marts import MARTS, MartSpec, build_mart, mart_from_states, mart_spec, partial_rows
from medallion.plans.lake import DAY, Lake, committed_folders, read_silver_rows, second_text
from medallion.schemas import MART_RUNS, SILVER
from medallion.sources import versions
from medallion.sources.tables import balanced, replace_table

LOADER = "silver_to_gold"
# The column of a state that tells its day: a mart's own columns may include the day of silver.
STATE_DAY = "_day"
DAYS = "days"


def refresh_mart(
    spark: SparkSession, lake: Lake, mart: str, batch_id: str, now: dt.datetime | None = None, by_days: bool = False
) -> int:
    """Rebuild one mart and record the run; the old mart stays until the new one is complete. ``by_days`` keeps
    states and reads changed days alone; the run's rows in are then the rows of these days."""
    spec = mart_spec(mart)
    started = now or dt.datetime.now(dt.timezone.utc)
    fields = {
        "batch_id": batch_id,
        "loader": LOADER,
        "mart": mart,
        "source_layer": "silver",
        "target_layer": "gold",
        "target_table": lake.gold(mart),
    }
    outcome = audit.recorded_run(
        spark,
        lake.audit("mart_runs"),
        MART_RUNS,
        started,
        fields,
        lambda: (_refresh_by_days if by_days else _refresh)(spark, lake, spec, batch_id, second_text(started)),
    )
    return outcome["rows_gold_out"]


def _refresh(spark: SparkSession, lake: Lake, spec: MartSpec, batch_id: str, built_at: str) -> dict[str, int]:
    silver = read_silver_rows(spark, lake)
    if silver is None:
        raise FileNotFoundError(f"there is no silver table at {lake.silver}")
    rows_in, n_in = audit.counting(silver)
    rows_out, n_out = audit.counting(build_mart(rows_in, spec, batch_id, built_at))
    replace_table(rows_out, lake.gold(spec.name))
    return {
        "rows_silver_in": audit.counted(n_in, silver.count),
        "rows_gold_out": audit.counted(n_out, lambda: 0),
    }


def _day(folder: str) -> str:
    return folder.rsplit("=", 1)[1]


def _days(folders: Iterable[str]) -> dict[str, list[str]]:
    """The folders of each day."""
    found: dict[str, list[str]] = {}
    for folder in sorted(folders):
        found.setdefault(_day(folder), []).append(folder)
    return found


def _digest(folders: list[str]) -> str:
    return hashlib.sha256("\n".join(folders).encode()).hexdigest()


def refresh_states(spark: SparkSession, lake: Lake, mart: str) -> int:
    """Compute the states of the days that changed; returns how many silver rows they hold. Of two runs that meet, the
    later one looks again. A failed run changes nothing."""
    spec, path = mart_spec(mart), lake.states(mart)
    while True:
        found = committed_folders(spark, lake.silver, lake.silver_ledger)
        if found is None:
            raise FileNotFoundError(f"there is no silver table at {lake.silver}")
        source, days = found[0], _days(found[1])
        now = versions.latest(spark, path) or versions.Version(0, ())
        made = {day: _digest(folders) for day, folders in days.items()}
        before = now.notes.get(DAYS, {})
        changed = {day for day in made.keys() | before.keys() if made.get(day) != before.get(day)}
        if now.number and not changed:
            return 0
        read = [folder for day in changed for folder in days.get(day, ())]
        rows, n_rows = audit.counting(versions.rows_of(spark, lake.silver, source, SILVER, sorted(read)))
        states = partial_rows(rows.withColumn(STATE_DAY, F.col(DAY)), spec, [STATE_DAY])
        entry = versions.write_attempt(balanced(states, STATE_DAY), path, [STATE_DAY])

        def step(current: versions.Version) -> list[versions.Entry] | None:
            if current.number != now.number:
                return None
            kept = [versions.Entry(e.attempt, tuple(f for f in e.folders if _day(f) not in changed)) for e in now.entries]
            return [*(left for left in kept if left.folders), entry]

        try:
            published = versions.change(spark, path, step, states.schema.json(), {DAYS: made})
        except Exception:
            versions.drop_attempt(spark, path, entry.attempt)
            raise
        if published is not None:
            versions.expire(spark, path)
            return audit.counted(n_rows, lambda: 0)
        versions.drop_attempt(spark, path, entry.attempt)


def _refresh_by_days(spark: SparkSession, lake: Lake, spec: MartSpec, batch_id: str, built_at: str) -> dict[str, int]:
    n_rows = refresh_states(spark, lake, spec.name)
    with versions.pinned(spark, lake.states(spec.name)) as version:
        states = versions.rows_of(spark, lake.states(spec.name), version)
        rows_out, n_out = audit.counting(mart_from_states(states, spec, batch_id, built_at))
        replace_table(rows_out, lake.gold(spec.name))
    return {"rows_silver_in": n_rows, "rows_gold_out": audit.counted(n_out, lambda: 0)}


def refresh_marts(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    marts: Iterable[str] = tuple(MARTS),
    now: dt.datetime | None = None,
    by_days: bool = False,
) -> dict[str, int]:
    return {mart: refresh_mart(spark, lake, mart, batch_id, now, by_days) for mart in marts}
