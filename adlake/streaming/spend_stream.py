"""ST1: hourly spend alerts on a cost stream.

The ad platform documents a 20-minute reporting delay, so the stream uses a
20-minute watermark and emits each (campaign, hour) window once, when the
watermark passes its end (append mode).  State per open window is one partial
sum per campaign; checkpoints go to the shared checkpoint folder.  Each
micro-batch of closed windows is joined to the history of the same hour and
weekday and to the account thresholds, by the rule of the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adlake.plans.operations import AlertParams, alert_thresholds, overspending

DELAY = "20 minutes"


def hourly_spend(stream: DataFrame, ts: str = "ts", key: str = "campaign_id", cost: str = "cost") -> DataFrame:
    return (stream.withWatermark(ts, DELAY)
            .groupBy(F.window(ts, "1 hour").alias("w"), F.col(key))
            .agg(F.sum(F.col(cost).cast("decimal(18,2)")).cast("double").alias("cost"), F.count("*").alias("n"))
            .select(key, F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"), "cost", "n"))


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def run_hourly_spend(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    s = spark.readStream.schema(schema).parquet(source)
    return _started(hourly_spend(s).writeStream.outputMode("append").format("parquet")
                    .option("checkpointLocation", checkpoint).option("path", sink), available_now)


def hourly_cost(stream: DataFrame) -> DataFrame:
    """Windows of enabled cost rows (account, campaign_id, name, status, ts,
    cost, amount) with their spend and budget."""
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return (stream.where(F.col("status") == "ENABLED").withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "1 hour").alias("w"), "account", "campaign_id")
            .agg(F.max("name").alias("name"), money("cost").alias("today"), money("amount").alias("budget"))
            .select("account", "campaign_id", "name", F.col("w.start").alias("hour_start"), "today", "budget"))


def hourly_history(history: DataFrame) -> DataFrame:
    """Spend of enabled rows by campaign, day and hour."""
    return (history.where(F.col("status") == "ENABLED")
            .groupBy("account", "campaign_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
            .agg(F.sum(F.col("cost").cast("decimal(18,2)")).alias("spent")))


def window_alerts(windows: DataFrame, history: DataFrame, config: DataFrame, p: AlertParams) -> DataFrame:
    """Closed windows against the same hour of the same weekdays in the
    lookback.  ``history`` is an hourly_history; the days before a window are
    an equi-join on campaign, hour and day."""
    day = F.to_date("hour_start")
    w = windows.withColumn("hour", F.hour("hour_start"))
    back = F.sequence(F.lit(7), F.lit(p.lookback_days), F.lit(7)) if p.lookback_days >= 7 else F.array().cast("array<int>")
    past = w.select("account", "campaign_id", "hour_start", "hour", F.explode(F.transform(back, lambda n: F.date_sub(day, n))).alias("day"))
    spent = past.join(history, ["account", "campaign_id", "day", "hour"]).groupBy("account", "campaign_id", "hour_start").agg(
        F.sum("spent").cast("double").alias("history"))
    totals = w.join(spent, ["account", "campaign_id", "hour_start"], "left").fillna(0.0, ["history"])
    return overspending(totals, alert_thresholds(config), p).select(
        "account", "contact", "campaign_id", "name", "hour_start", "hour", "today", "budget", "average", "difference", "pct_change", "pct")


def run_spend_alerts(spark: SparkSession, source: str, schema: StructType, history: DataFrame, config: DataFrame, p: AlertParams,
                     sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Alerts of every closed window, appended to ``sink`` in a folder for each
    micro-batch; a batch that is run again replaces its own folder."""
    def alert(batch: DataFrame, batch_id: int) -> None:
        window_alerts(batch, history, config, p).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    stream = hourly_cost(spark.readStream.schema(schema).parquet(source))
    return _started(stream.writeStream.outputMode("append").foreachBatch(alert).option("checkpointLocation", checkpoint), available_now)
