"""Staging views and marts over the clean warehouse tables.

Every mart aggregates its child first (partial + final aggregate, so a hot
key is pre-combined on the map side) and then left-joins one row per key to
its parent, so no join ever sees a repeated key on both sides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ``w`` below is any mapping from warehouse table name (guests, properties,
# rooms, reservations, payments) to its DataFrame: the staged clean tables of
# a run, or the parquet tables a job wrote.
Warehouse = Mapping[str, DataFrame]

TOTAL_TYPE = "decimal(20,2)"     # sum of decimal(10,2) amounts per reservation
REVENUE_TYPE = "decimal(30,2)"   # sum of those per property


def stg_guests(w: Warehouse) -> DataFrame:
    return w["guests"].select("guest_id", "first_name", "last_name", "email", "phone", "country")


def stg_properties(w: Warehouse) -> DataFrame:
    return w["properties"].select("property_id", "property_name", "city", "country")


def stg_rooms(w: Warehouse) -> DataFrame:
    return w["rooms"].select("room_id", "property_id", "room_type", "capacity")


def stg_reservations(w: Warehouse) -> DataFrame:
    r = w["reservations"]
    return r.select(
        "reservation_id", "guest_id", "property_id", "room_id", "check_in_date", "check_out_date",
        "booking_status", "booking_date",
        F.datediff("check_out_date", "check_in_date").alias("nights_booked"),
    )


def stg_payments(w: Warehouse) -> DataFrame:
    return w["payments"].select(
        "payment_id", "reservation_id", "payment_date", "payment_method", "amount", "payment_status"
    )


def payments_per_reservation(w: Warehouse) -> DataFrame:
    """Paid amount (paid rows only), all-status record count and latest payment date per reservation."""
    p = stg_payments(w)
    return p.groupBy("reservation_id").agg(
        F.sum(F.when(F.col("payment_status") == "paid", F.col("amount"))
              .otherwise(F.lit(0).cast("decimal(10,2)"))).cast(TOTAL_TYPE).alias("amount_paid"),
        F.count(F.lit(1)).alias("payment_record_count"),
        F.max("payment_date").alias("last_payment_date"),
    )


def fct_reservations(w: Warehouse, payments: DataFrame | None = None) -> DataFrame:
    """One row per reservation with its payment roll-up (0 when it has no payments); ``payments`` may come from kept states."""
    r = stg_reservations(w)
    p = payments_per_reservation(w) if payments is None else payments
    j = r.join(p, "reservation_id", "left")
    return j.select(
        "reservation_id", "guest_id", "property_id", "room_id", "check_in_date", "check_out_date",
        "nights_booked", "booking_status", "booking_date",
        F.coalesce(F.col("amount_paid"), F.lit(0).cast(TOTAL_TYPE)).alias("amount_paid"),
        F.coalesce(F.col("payment_record_count"), F.lit(0).cast("bigint")).alias("payment_record_count"),
        F.col("last_payment_date"),
    )


def guest_activity(w: Warehouse) -> DataFrame:
    r = stg_reservations(w)
    return r.groupBy("guest_id").agg(
        F.count(F.lit(1)).alias("total_reservations"),
        F.count_if(F.col("booking_status") == "cancelled").alias("cancelled_reservations"),
        F.count_if(F.col("booking_status") == "no_show").alias("no_show_reservations"),
        F.min("check_in_date").alias("first_check_in_date"),
        F.max("check_in_date").alias("most_recent_check_in_date"),
    )


def dim_guests(w: Warehouse, activity: DataFrame | None = None) -> DataFrame:
    """One row per guest with booking activity (0 / NULL when the guest never booked); ``activity`` may come from kept states."""
    g = stg_guests(w)
    a = guest_activity(w) if activity is None else activity
    j = g.join(a, "guest_id", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "guest_id", "first_name", "last_name", "email", "phone", "country",
        F.coalesce("total_reservations", zero).alias("total_reservations"),
        F.coalesce("cancelled_reservations", zero).alias("cancelled_reservations"),
        F.coalesce("no_show_reservations", zero).alias("no_show_reservations"),
        "first_check_in_date", "most_recent_check_in_date",
    )


def room_counts(w: Warehouse) -> DataFrame:
    """Rooms per property id (only ids that have rooms)."""
    return stg_rooms(w).groupBy("property_id").agg(F.count(F.lit(1)).alias("room_count"))


def rooms_per_property(w: Warehouse) -> DataFrame:
    """Room count per property, 0 for a property without rooms (the correlated count, decorrelated)."""
    rooms = room_counts(w)
    p = stg_properties(w).select("property_id")
    return p.join(rooms, "property_id", "left").select(
        "property_id", F.coalesce("room_count", F.lit(0).cast("bigint")).alias("room_count")
    )


def half_up_avg(total: str, n: str, scale: int = 2):
    """round(total / n, scale) half away from zero, exact for non-negative integer totals.

    Integer arithmetic only: floor((2 * 10^scale * total + n) / (2 * n)) / 10^scale.
    """
    f = 10 ** scale
    q = F.expr(f"({2 * f} * `{total}` + `{n}`) div (2 * `{n}`)")
    return F.when(F.col(n) > 0, (q.cast("decimal(20,0)") / F.lit(f)).cast("decimal(18,2)"))


def property_activity(w: Warehouse) -> DataFrame:
    f = fct_reservations(w)
    status = F.col("booking_status")
    return f.groupBy("property_id").agg(
        F.count(F.lit(1)).alias("total_reservations"),
        F.count_if(status.isin("checked_in", "checked_out")).alias("completed_stays"),
        F.count_if(status == "cancelled").alias("cancelled_reservations"),
        F.count_if(status == "no_show").alias("no_show_reservations"),
        F.sum("amount_paid").cast(REVENUE_TYPE).alias("total_revenue"),
        F.sum("nights_booked").cast("bigint").alias("_nights_total"),
        F.count("nights_booked").alias("_nights_n"),
    )


def agg_property_performance(w: Warehouse, activity: DataFrame | None = None) -> DataFrame:
    """One row per property, including properties without rooms or bookings; ``activity`` may come from kept states."""
    p = stg_properties(w)
    rc = room_counts(w)
    a = property_activity(w) if activity is None else activity
    j = p.join(rc, "property_id", "left").join(a, "property_id", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "property_id", "property_name", "city", "country",
        F.coalesce("room_count", zero).alias("room_count"),
        F.coalesce("total_reservations", zero).alias("total_reservations"),
        F.coalesce("completed_stays", zero).alias("completed_stays"),
        F.coalesce("cancelled_reservations", zero).alias("cancelled_reservations"),
        F.coalesce("no_show_reservations", zero).alias("no_show_reservations"),
        F.coalesce("total_revenue", F.lit(0).cast(REVENUE_TYPE)).alias("total_revenue"),
        half_up_avg("_nights_total", "_nights_n").alias("avg_nights_booked"),
    )


MARTS = {
    "fct_reservations": fct_reservations,
    "dim_guests": dim_guests,
    "agg_property_performance": agg_property_performance,
}
STAGING = {
    "stg_guests": stg_guests,
    "stg_properties": stg_properties,
    "stg_rooms": stg_rooms,
    "stg_reservations": stg_reservations,
    "stg_payments": stg_payments,
}
