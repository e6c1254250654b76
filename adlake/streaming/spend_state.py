"""ST1 with state: spend alerts that remember four weeks of hourly spend.

Each campaign's state holds its spend by hour, in cents, for the lookback; an
hour is closed when the watermark passes its end, compared with the same hour
7, 14, .. days before out of the state alone, and kept until no hour can look
back at it.  No batch reads the history again.  The state of a campaign is at
most ``24 * lookback_days`` hours and the open ones, and it goes when its last
hour expires.  Rows that are not newer than the watermark are late: they are
dropped and change no hour.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from adlake.plans.operations import AlertParams, alert_thresholds, overspending
from adlake.streaming.spend_stream import DELAY, _started

HOUR_MS = 3_600_000
WINDOWS = "account string, campaign_id long, name string, hour_ms long, today long, budget long, history long"
STATE = "name string, hours array<long>, spent array<long>, budget array<long>"


def _campaign_hours(lookback_days: int):
    """The state function: closed hours of one campaign, with their history."""
    back = [24 * n for n in range(7, lookback_days + 1, 7)]
    kept = 24 * lookback_days

    def advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, spent = None, {}
        if state.exists:
            name, hours, cents, budget = state.get
            spent = {h: [c, b] for h, c, b in zip(hours, cents, budget)}
        watermark = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for part in rows:
                part = part[part["ms"] > watermark]
                for hour, cost, amount in zip((part["ms"] // HOUR_MS).tolist(), part["cents"].tolist(), part["budget"].tolist()):
                    total = spent.setdefault(hour, [0, 0])
                    total[0] += cost
                    total[1] += amount
                if len(part):
                    name = max(filter(None, [name, part["name"].max()]), default=None)
        open_from = max(watermark, 0) // HOUR_MS  # hours before are closed
        closed = sorted(h for h in spent if h < open_from and spent[h][1] is not None)
        if closed:
            yield pd.DataFrame({
                "account": key[0], "campaign_id": key[1], "name": name, "hour_ms": [h * HOUR_MS for h in closed],
                "today": [spent[h][0] for h in closed], "budget": [spent[h][1] for h in closed],
                "history": [sum(spent[h - n][0] for n in back if h - n in spent) for h in closed]})
        # a closed hour's budget is no longer needed: null marks it
        spent = {h: [c, None if h < open_from else b] for h, (c, b) in spent.items() if h >= open_from - kept}
        if not spent:
            state.remove()
            return
        hours = sorted(spent)
        state.update((name, hours, [spent[h][0] for h in hours], [spent[h][1] for h in hours]))
        waiting = [h for h in hours if spent[h][1] is not None]
        until = (waiting[0] + 1) * HOUR_MS - 1 if waiting else (hours[-1] + kept + 1) * HOUR_MS
        state.setTimeoutTimestamp(max(until, watermark + 1))

    return advance


def closed_hours(stream: DataFrame, lookback_days: int = 28) -> DataFrame:
    """WINDOWS (amounts in cents; hour_start in place of hour_ms) of a stream of cost rows (account,
    campaign_id, name, status, ts, cost, amount), enabled ones only."""
    cents = lambda c: F.coalesce((F.col(c).cast("decimal(18,2)") * 100).cast("long"), F.lit(0))
    rows = stream.where((F.col("status") == "ENABLED") & F.col("ts").isNotNull()).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", DELAY).select(
        "account", F.col("campaign_id").cast("long").alias("campaign_id"), "name", "ts", F.unix_millis("ts").alias("ms"),
        cents("cost").alias("cents"), cents("amount").alias("budget"))
    hours = rows.groupBy("account", "campaign_id").applyInPandasWithState(
        _campaign_hours(lookback_days), WINDOWS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return hours.withColumn("hour_ms", F.timestamp_millis("hour_ms")).withColumnRenamed("hour_ms", "hour_start")


def state_alerts(windows: DataFrame, config: DataFrame, p: AlertParams) -> DataFrame:
    """Closed hours that pass their account's thresholds."""
    euros = windows.withColumns({c: F.col(c) / 100.0 for c in ("today", "budget", "history")})
    return overspending(euros, alert_thresholds(config), p).select(
        "account", "contact", "campaign_id", "name", "hour_start", F.hour("hour_start").alias("hour"), "today", "budget", "average", "difference", "pct_change", "pct")


def run_state_alerts(spark: SparkSession, source: str, schema: StructType, config: DataFrame, p: AlertParams, sink: str, checkpoint: str,
                     max_files: int = 1, available_now: bool = True) -> StreamingQuery:
    """Alerts appended to ``sink``; ``max_files`` landed files make a batch."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    alerts = state_alerts(closed_hours(stream, p.lookback_days), config, p)
    return _started(alerts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", sink), available_now)
