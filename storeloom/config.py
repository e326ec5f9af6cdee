"""Business rules as one value object; every function takes it as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from types import MappingProxyType
from collections.abc import Mapping

# Family prefix -> product category.
PRODUCT_CATEGORIES = MappingProxyType({
    "S10": "Scale Models",
    "S12": "Motorcycles",
    "S18": "Trucks and Buses",
    "S24": "Classic Cars",
})


@dataclass(frozen=True)
class Rules:
    """Thresholds of the sales model.

    Amounts and rates are decimals so that money never passes through binary
    floating point.
    """

    high_value_customer: Decimal = Decimal(10000)
    medium_value_customer: Decimal = Decimal(5000)
    large_order: Decimal = Decimal(5000)
    restocking_fee_rate: Decimal = Decimal("0.10")
    lower_percentile: float = 0.33
    upper_percentile: float = 0.67
    product_categories: Mapping[str, str] = field(default_factory=lambda: PRODUCT_CATEGORIES)


@dataclass(frozen=True)
class QualityThresholds:
    """Accepted shares of the quality gate."""

    completeness: float = 0.95
    email_validity: float = 0.90
    orphaned_share: float = 0.05
    anomalous_share: float = 0.01
    rejected_share: float = 0.05


DEFAULT_RULES = Rules()
DEFAULT_THRESHOLDS = QualityThresholds()
