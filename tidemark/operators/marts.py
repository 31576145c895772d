"""Daily marts over staging, for every tenant in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.contract import MARTS, TOTAL
from tidemark.functions.casts import ratio


def _total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast(TOTAL))


def daily_revenue(orders: DataFrame, refunds: DataFrame, tenant: DataFrame) -> DataFrame:
    """Gross by order day against refunds by refund day; refunds without an order are kept apart."""
    sales = orders.filter("order_date IS NOT NULL").groupBy("tenant_id", F.col("order_date").alias("day")).agg(
        F.count("gross").alias("orders"), _total(F.col("gross")).alias("gross"))
    tied = F.when(~F.col("is_orphan"), F.col("amount"))
    orphan = F.when(F.col("is_orphan"), F.col("amount"))
    returned = refunds.filter("refund_date IS NOT NULL").groupBy("tenant_id", F.col("refund_date").alias("day")).agg(
        _total(tied).alias("refunds"), F.count_if("is_orphan").alias("orphan_refund_count"),
        _total(orphan).alias("orphan_refund_amount"))
    days = sales.join(returned, ["tenant_id", "day"], "full_outer").join(tenant, "tenant_id")
    gross, refunded = _or_zero(F.col("gross")), _or_zero(F.col("refunds"))
    return days.select(
        "tenant_id", "day", "currency",
        F.coalesce("orders", F.lit(0)).cast("int").alias("orders"),
        gross.alias("gross"), refunded.alias("refunds"), (gross - refunded).cast(TOTAL).alias("net"),
        F.coalesce("orphan_refund_count", F.lit(0)).cast("int").alias("orphan_refund_count"),
        _or_zero(F.col("orphan_refund_amount")).alias("orphan_refund_amount"),
    )


def daily_ad_spend(ad_spend: DataFrame, tenant: DataFrame) -> DataFrame:
    totals = ad_spend.groupBy("tenant_id", F.col("spend_date").alias("day"), "platform").agg(
        _total(F.col("spend")).alias("spend"))
    return totals.join(tenant, "tenant_id").select("tenant_id", "day", "platform", "currency", "spend")


def daily_email_engagement(email_events: DataFrame) -> DataFrame:
    def count(value: str) -> Column:
        return F.count_if(F.col("event_type") == value).cast("int")

    return email_events.filter("event_date IS NOT NULL").groupBy("tenant_id", F.col("event_date").alias("day")).agg(
        count("delivered").alias("delivered"), count("open").alias("opens"),
        count("click").alias("clicks"), count("unsubscribe").alias("unsubscribes"))


def daily_channel_performance(orders: DataFrame, ad_spend: DataFrame, tenant: DataFrame) -> DataFrame:
    """Gross per channel against spend on the platform of the same name. ROAS is NULL without spend."""
    revenue = orders.filter("order_date IS NOT NULL AND channel IS NOT NULL").groupBy(
        "tenant_id", F.col("order_date").alias("day"), "channel").agg(_total(F.col("gross")).alias("revenue"))
    spend = ad_spend.groupBy(
        "tenant_id", F.col("spend_date").alias("day"), F.col("platform").alias("channel")
    ).agg(_total(F.col("spend")).alias("spend"))
    both = revenue.join(spend, ["tenant_id", "day", "channel"], "full_outer").join(tenant, "tenant_id")
    earned = _or_zero(F.col("revenue"))
    return both.select(
        "tenant_id", "day", "channel", "currency", earned.alias("revenue"), _or_zero(F.col("spend")).alias("spend"),
        ratio(earned, F.col("spend")).alias("roas"),
    )


def build(staged: dict[str, DataFrame], tenant: DataFrame, marts: list[str] | None = None) -> dict[str, DataFrame]:
    currency = tenant.select("tenant_id", "currency")
    makers = {
        "daily_revenue": lambda: daily_revenue(staged["orders"], staged["refunds"], currency),
        "daily_ad_spend": lambda: daily_ad_spend(staged["ad_spend"], currency),
        "daily_email_engagement": lambda: daily_email_engagement(staged["email_events"]),
        "daily_channel_performance": lambda: daily_channel_performance(staged["orders"], staged["ad_spend"], currency),
    }
    return {name: makers[name]() for name in (marts or list(MARTS))}


def reconcile(daily: DataFrame, summary: DataFrame) -> DataFrame:
    """Every day on which a client's own gross differs from ours, or that only one side has.

    `daily` and `summary` both have (tenant_id, day, gross).
    """
    ours = daily.select("tenant_id", "day", F.col("gross").alias("gross"))
    theirs = summary.select("tenant_id", "day", F.col("gross").alias("gross_reported"))
    both = ours.join(theirs, ["tenant_id", "day"], "full_outer")
    return both.select(
        "tenant_id", "day", "gross", "gross_reported",
        (F.coalesce("gross", F.lit(0)) - F.coalesce("gross_reported", F.lit(0))).alias("difference"),
    ).filter("NOT (gross <=> gross_reported)")
