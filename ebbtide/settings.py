"""Parameters of every stage, as plain dataclasses with the production defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from ebbtide.contracts import RANGES


@dataclass(frozen=True)
class CleaningRules:
    # fixed values: codes that are postage, fees or vouchers, not products
    non_product_codes: tuple[str, ...] = (
        "POST", "D", "DOT", "M", "C2", "CRUK", "S", "B", "BANK CHARGES", "PADS", "AMAZONFEE", "GIFT",
    )
    drop_missing_customer: bool = True
    min_unit_price: float = 0.0


@dataclass(frozen=True)
class LabelSpec:
    activity_window_days: int = 180
    horizon_days: int = 90


@dataclass(frozen=True)
class SplitSpec:
    train: tuple[str, ...]
    valid: tuple[str, ...]
    test: tuple[str, ...]
    purged: tuple[str, ...] = ()

    def fold_of(self) -> dict[str, str]:
        named = (("train", self.train), ("valid", self.valid), ("test", self.test), ("purged", self.purged))
        return {day: fold for fold, days in named for day in days}


@dataclass(frozen=True)
class Economics:
    margin: float = 45.0
    offer_cost: float = 8.0
    uplift: float = 0.30
    capacity: float = 0.20

    @property
    def break_even_precision(self) -> float:
        return self.offer_cost / (self.uplift * self.margin)


@dataclass(frozen=True)
class GateThresholds:
    min_roc_auc: float = 0.72
    min_pr_auc: float = 0.55
    max_brier: float = 0.21
    min_recall_at_top_decile: float = 0.15
    min_precision_at_top_quintile: float = 0.60
    max_auc_regression: float = 0.01


@dataclass(frozen=True)
class MonitorThresholds:
    bins: int = 10
    psi_warn: float = 0.10
    psi_alert: float = 0.25
    ks_pvalue: float = 0.01
    ks_min_rows: int = 20
    null_rate: float = 0.02
    out_of_range_share: float = 0.01
    drift_share: float = 0.30
    drift_alerts: int = 3
    min_rows: int = 200


@dataclass(frozen=True)
class RetrainPolicy:
    max_model_age_days: int = 30
    min_new_labelled_snapshots: int = 1
    auc_drop: float = 0.05
    drift_share: float = 0.30


@dataclass(frozen=True)
class ServingRules:
    default_threshold: float = 0.5
    high_risk: float = 0.70
    medium_risk: float = 0.40
    latency_slo_ms: float = 150.0
    top_contributions: int = 5


@dataclass(frozen=True)
class Settings:
    system_asof: str
    snapshots: tuple[str, ...]
    split: SplitSpec
    label: LabelSpec = LabelSpec()
    cleaning: CleaningRules = CleaningRules()
    economics: Economics = Economics()
    gates: GateThresholds = GateThresholds()
    monitor: MonitorThresholds = MonitorThresholds()
    retrain: RetrainPolicy = RetrainPolicy()
    serving: ServingRules = ServingRules()
    ranges: dict = field(default_factory=lambda: dict(RANGES))
    top_countries: int = 6
    seed: int = 42


# The star-schema tables span 1995-2001, so day counts need a wider range; 2001-06-30 is right-censored.
STAR = Settings(
    system_asof="2001-08-01",
    snapshots=(
        "2000-08-31", "2000-09-30", "2000-10-31", "2000-11-30", "2000-12-31", "2001-01-31", "2001-06-30",
    ),
    split=SplitSpec(
        train=("2000-08-31", "2000-09-30", "2000-10-31"),
        valid=("2000-11-30",),
        purged=("2000-12-31",),
        test=("2001-01-31",),
    ),
    ranges={**RANGES, "recency_days": (0.0, 3000.0), "tenure_days": (0.0, 3000.0)},
)
