"""Batch forms of the streaming operators, for whole histories."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.operators.blocks import Ordered


def retry_outcomes(attempts: DataFrame) -> DataFrame:
    """Final status per notification: SENT at the first success, DEAD at the last allowed failure.

    `attempts` has notification_id, attempt_id, attempt_at and delivered.  Only the first
    success and the first failures are kept per notification, before the shuffle as well.
    """
    early = Window.partitionBy("notification_id", "delivered").orderBy("attempt_at", "attempt_id")
    kept = attempts.withColumn("_place", F.row_number().over(early)).where(
        F.col("_place") <= K.MAX_RETRY_COUNT
    )
    when = F.struct("attempt_at", "attempt_id")
    per = kept.groupBy("notification_id").agg(
        F.min(F.when(F.col("delivered"), when)).alias("_success"),
        F.array_sort(F.collect_list(F.when(~F.col("delivered"), when))).alias("_failures"),
    )
    counted = per.withColumn(
        "_counted",
        F.filter("_failures", lambda f: F.col("_success").isNull() | (f < F.col("_success"))),
    )
    count = F.size("_counted")
    status = (
        F.when(count >= K.MAX_RETRY_COUNT, "DEAD")
        .when(F.col("_success").isNotNull(), "SENT")
        .otherwise("RETRY")
    )
    last_failure = F.element_at("_counted", -1)["attempt_at"]
    at = F.when(status == "SENT", F.col("_success.attempt_at")).otherwise(
        F.when(count > 0, last_failure)
    )
    return counted.select(
        "notification_id",
        status.alias("notification_status"),
        count.alias("retry_count"),
        at.alias("changed_at"),
        F.when(status == "RETRY", at + F.expr(f"INTERVAL {K.RETRY_DELAY}")).alias("next_retry_at"),
    )


def stuck_intervals(changes: DataFrame, until: Column) -> DataFrame:
    """PROCESSING changes that no other change followed within the staleness limit.

    The last change of an entity counts when `until` lies past the limit.
    """
    ordered = Ordered(
        changes.select("entity_id", "changed_at", "change_id", "status"),
        ["entity_id"], ["changed_at", "change_id"], name="stuck",
    )
    limit = F.col("changed_at") + F.expr(f"INTERVAL {K.STALE_AFTER}")
    following = ordered.neighbour({"next_at": "changed_at"}, 1).result()
    return following.where(
        (F.col("status") == "PROCESSING")
        & (F.coalesce(F.col("next_at"), until) > limit)
    ).select("entity_id", F.col("changed_at").alias("stuck_since"), limit.alias("detected_at"))


def sessions(
    events: DataFrame, key: str, time: str, tie: str, gap=K.STALE_AFTER
) -> DataFrame:
    """Sessions per key: runs of events less than `gap` apart; a busy key spans many blocks."""
    ordered = Ordered(events.select(key, time, tie), [key], [time, tie], name="sessions")
    ordered.neighbour({"_previous": time}, -1)
    pause = F.expr(f"INTERVAL {gap}")
    starts = F.col("_previous").isNull() | (F.col(time) > F.col("_previous") + pause)
    numbered = ordered.running(
        sums={"_session": F.when(starts, 1).otherwise(0).cast("bigint")}
    ).result()
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min(time).alias("session_start"),
            (F.max(time) + pause).alias("session_end"),
            F.count("*").alias("event_count"),
        )
        .drop("_session")
    )
