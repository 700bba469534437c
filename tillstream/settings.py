"""Thresholds and windows. The defaults are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class AnomalyRules:
    high_value: float = 5000.0
    quantity: int = 10
    rapid_limit: int = 5
    rapid_window: str = "1 minute"


@dataclass(frozen=True)
class SalesWindows:
    length: str = "1 minute"
    slide: str | None = "30 seconds"
    watermark: str = "1 minute"


@dataclass(frozen=True)
class StockRules:
    initial: int = 80
    threshold: int = 65
    window: str = "1 minute"
    watermark: str = "1 minute"


@dataclass(frozen=True)
class SessionRules:
    gap_seconds: int = 120
    abandoned_after_seconds: int = 60
    watermark: str = "5 minutes"
    purchase_horizon_seconds: int = 1800


@dataclass(frozen=True)
class AlertRules:
    low_stock: int = 10
    critical_stock: int = 5
    anomaly_score: float = 0.8
    high_risk_score: float = 0.9
    urgent_score: float = 0.95
    carts_per_hour: int = 20
    cart_value: float = 1000.0
    repeat_after: str = "1 hour"
    page: int = 20
    cpu_percent: float = 90.0
    memory_percent: float = 90.0


@dataclass(frozen=True)
class RfmRules:
    quantiles: int = 5
