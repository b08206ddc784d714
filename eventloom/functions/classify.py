"""Row and aggregate classifications. Branch order is part of the result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def activity_level(events: Column, high: int = 100, medium: int = 50) -> Column:
    return (
        F.when(events > high, "HIGH_ACTIVITY")
        .when(events > medium, "MEDIUM_ACTIVITY")
        .otherwise("LOW_ACTIVITY")
    )


def session_type(
    events: Column, purchases: Column, browser_over: int = 20, quick_under: int = 5
) -> Column:
    return (
        F.when(purchases > 0, "CONVERTER")
        .when(events > browser_over, "BROWSER")
        .when(events < quick_under, "QUICK_VISIT")
        .otherwise("REGULAR")
    )


def customer_segment(
    events: Column,
    purchases: Column,
    high: tuple[int, int] = (100, 5),
    regular: tuple[int, int] = (50, 2),
    browser_over: int = 20,
) -> Column:
    return (
        F.when((events > high[0]) & (purchases > high[1]), "HIGH_VALUE_CUSTOMER")
        .when((events > regular[0]) & (purchases > regular[1]), "REGULAR_CUSTOMER")
        .when((events > browser_over) & (purchases == 0), "BROWSER")
        .otherwise("OCCASIONAL_USER")
    )


def anomaly_flag(
    burst: Column,
    amount: Column,
    types: Column,
    burst_over: int = 20,
    amount_over: int = 1000,
    types_over: int = 5,
) -> Column:
    """``amount`` is NULL unless the event is a purchase."""
    return (
        F.when(burst > burst_over, "SUSPICIOUS_ACTIVITY")
        .when(amount > amount_over, "HIGH_VALUE_TRANSACTION")
        .when(types > types_over, "RAPID_BEHAVIOR_CHANGE")
        .otherwise("NORMAL")
    )


def risk_score(burst: Column, high: int = 50, medium: int = 30, low: int = 15) -> Column:
    return F.when(burst > high, 5).when(burst > medium, 3).when(burst > low, 2).otherwise(1)


def age_group(age: Column, adult_from: int = 18) -> Column:
    return F.when(age >= adult_from, "adult").otherwise("minor")
