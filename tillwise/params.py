"""All thresholds as parameters, defaults equal to the reference pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CleaningParams:
    """Silver cleaning rules."""
    timestamp_format: str = "dd-MM-yyyy HH:mm"
    min_quantity_exclusive: int = 0          # Quantity > 0
    min_unit_price: float = 0.01             # UnitPrice >= 0.01
    extreme_quantity: int = 10000            # flag Quantity > 10000
    extreme_price: float = 5000.0            # flag UnitPrice > 5000
    home_country: str = "United Kingdom"
    cancel_prefix: str = "C"


@dataclass(frozen=True)
class SegmentParams:
    """RFM segmentation mart."""
    buckets: int = 5
    # True: score 5 = best (documented intent). False: as coded (bucket 1 = best).
    best_is_high: bool = True
    whale_percentile: float = 0.99
    # None: observation end (max invoice timestamp) is the recency anchor.
    anchor: str | None = None


@dataclass(frozen=True)
class ChurnParams:
    """Churn feature mart."""
    high_value_line: float = 1000.0
    bulk_quantity: int = 100
    whale_spend: float = 50000.0
    inactive_long: int = 90
    inactive_short: int = 60
    # engagement = tx*w_tx + spend/100*w_spend + products*w_products + months*w_months
    w_tx: str = "0.3"
    w_spend: str = "0.3"
    w_products: str = "0.2"
    w_months: str = "0.2"


@dataclass(frozen=True)
class ClvParams:
    """Heuristic lifetime value."""
    days_per_month: float = 30.0
    min_months: float = 1.0
    max_freq_per_month: float = 10.0
    horizon_months: int = 12
    purchases_horizon_months: int = 6
    alive_floor: float = 0.05
    alive_cap: float = 0.95
    one_time_purchases: float = 0.5
    top_share: float = 0.1
    deciles: int = 10
    corrected_alive: bool = False
    # "line" counts repeat lines (as coded); "invoice" counts repeat invoices.
    unit: str = "line"


@dataclass(frozen=True)
class ModelParams:
    """Churn models."""
    seed: int = 42
    train_fraction: float = 0.8
    folds: int = 5
    lr_max_iter: int = 1000
    lr_c: float = 1.0
    rf_trees: int = 200
    rf_depth: int = 10
    rf_min_leaf: int = 10
    threshold: float = 0.5
    score_model: str = "lr"
    parallelism: int = 5             # concurrent fold fits


@dataclass(frozen=True)
class ClusterParams:
    k: int = 4
    k_min: int = 2
    k_max: int = 10
    restarts: int = 10
    seed: int = 42
    max_iter: int = 300
    parallelism: int = 8             # concurrent fits (restarts, K sweep)


@dataclass(frozen=True)
class Params:
    cleaning: CleaningParams = field(default_factory=CleaningParams)
    segments: SegmentParams = field(default_factory=SegmentParams)
    churn: ChurnParams = field(default_factory=ChurnParams)
    clv: ClvParams = field(default_factory=ClvParams)
    model: ModelParams = field(default_factory=ModelParams)
    cluster: ClusterParams = field(default_factory=ClusterParams)
