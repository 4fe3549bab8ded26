"""Survival of customers: product-limit estimates with censoring, and retention of cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def product_limit(lives: DataFrame, group: str, duration: str, ended: Column) -> DataFrame:
    """(group, duration, at_risk, n_ended, n_censored, survival, variance) for each duration met.

    A life that has not `ended` is censored: it is at risk up to its duration, that included.  Lives
    are counted by group and duration within each task first, so the windows run over distinct
    durations.  `survival` is a product of whole-number ratios, 0 once all at risk have ended;
    `variance` is Greenwood's, NULL from there on.  Rows without a duration count nothing; those without
    a group are a group.
    """
    counts = (
        lives.filter(F.col(duration).isNotNull())
        .groupBy(group, duration)
        .agg(
            F.sum(F.when(ended, 1).otherwise(0)).alias("n_ended"),
            F.sum(F.when(ended, 0).otherwise(1)).alias("n_censored"),
        )
    )
    ordered = Window.partitionBy(group).orderBy(duration)
    upto, from_on = (
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    risked = counts.withColumn("at_risk", F.sum(F.col("n_ended") + F.col("n_censored")).over(from_on))
    left = F.col("at_risk") - F.col("n_ended")
    over = F.max((left == 0).cast("int")).over(upto) == 1
    # Logarithms of the factors add up; a factor of 0 has none and ends the product.
    product = F.exp(F.sum(F.when(left > 0, F.log(left / F.col("at_risk"))).otherwise(0.0)).over(upto))
    greenwood = F.sum(F.when(left > 0, F.col("n_ended") / (F.col("at_risk") * left)).otherwise(0.0)).over(upto)
    return risked.select(
        group,
        duration,
        "at_risk",
        "n_ended",
        "n_censored",
        F.when(over, 0.0).otherwise(product).alias("survival"),
        F.when(~over, product * product * greenwood).alias("variance"),
    )


def retention(events: DataFrame, who: str, period: Column) -> DataFrame:
    """(cohort, age, n): of those first seen in period `cohort`, how many were seen `age` periods later.

    `period` is a whole number.
    """
    active = events.select(F.col(who).alias("who"), period.alias("period")).filter("who IS NOT NULL AND period IS NOT NULL").distinct()
    first = active.groupBy("who").agg(F.min("period").alias("cohort"))
    both = active.join(first, "who")
    return both.groupBy("cohort", (F.col("period") - F.col("cohort")).alias("age")).agg(F.count("*").alias("n"))
