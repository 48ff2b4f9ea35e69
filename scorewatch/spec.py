"""Typed run specifications. Plain values only; nothing here touches Spark."""
from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from fractions import Fraction


def shift_month(month: str, months: int) -> str:
    """``"2001-05", -3`` -> ``"2001-02"``."""
    year, number = (int(part) for part in month.split("-"))
    index = year * 12 + number - 1 + months
    return date(index // 12, index % 12 + 1, 1).strftime("%Y-%m")


def as_fraction(value: float | Fraction) -> Fraction:
    """Exact fraction of a decimal literal, so that 0.7 of 10 rows is 7 rows."""
    return value if isinstance(value, Fraction) else Fraction(str(value))


@dataclass(frozen=True)
class Source:
    """The scored account table."""

    keys: tuple[str, ...]
    month: str
    score: str
    channel: str
    channels: tuple[str, ...]
    features: tuple[str, ...] = ()
    business: tuple[str, ...] = ()
    table: str | None = None

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.keys, self.month, self.score, self.channel, *self.features, *self.business)


@dataclass(frozen=True)
class Bucket:
    """Right-closed value ranges; one more label than boundaries."""

    name: str
    column: str
    boundaries: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.labels) != len(self.boundaries) + 1:
            raise ValueError(
                f"bucket '{self.name}' needs {len(self.boundaries) + 1} labels, got {len(self.labels)}"
            )


@dataclass(frozen=True)
class Enrichment:
    dynamic_partition: tuple[str, ...]
    n_bins: int = 10
    decile_col: str = "risk_decile_dyn"
    band_col: str | None = "risk_band_dyn"
    bands: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    static_partition: tuple[str, ...] = ("channel",)
    static_bins: int = 10
    static_col: str = "risk_decile_static"
    buckets: tuple[Bucket, ...] = ()
    flags: Mapping[str, str] = field(default_factory=dict)
    hook: Callable | None = None


@dataclass(frozen=True)
class Metric:
    func: str
    alias: str
    col: str | None = None


@dataclass(frozen=True)
class Share:
    """``source`` divided by its total within ``over``."""

    name: str
    source: str | None = None
    over: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    group_by: tuple[str, ...]
    metrics: tuple[Metric, ...]
    shares: tuple[Share, ...] = ()


@dataclass(frozen=True)
class Segment:
    column: str
    segment_type: str


@dataclass(frozen=True)
class DriftSpec:
    n_bins: int = 10
    quantiles: tuple[float, ...] = (0.50, 0.80, 0.90, 0.95)
    top_shares: tuple[float, ...] = (0.10, 0.05)
    tail_quantiles: tuple[float, ...] = (0.90, 0.95)
    score_bounds: tuple[float, float] = (0.0, 1.0)
    outlier_quantiles: tuple[float, float] = (0.01, 0.99)
    segments: tuple[Segment, ...] = ()


@dataclass(frozen=True)
class Limit:
    warning: float
    alert: float


# Limits used when a metric is configured at no level.
BUILTIN_LIMITS: Mapping[str, Limit] = {
    "psi": Limit(0.10, 0.25),
    "ks_drop": Limit(-0.03, -0.07),
    "calibration_gap": Limit(0.02, 0.05),
    "edr_delta": Limit(0.01, 0.03),
    "missing_rate": Limit(0.01, 0.05),
    "feature_psi": Limit(0.10, 0.25),
}

# Metrics for which a smaller value is the worse one.
LOWER_IS_WORSE = frozenset({"ks_drop"})


@dataclass(frozen=True)
class Thresholds:
    default: Mapping[str, Limit] = field(default_factory=dict)
    model: Mapping[str, Limit] = field(default_factory=dict)
    scorecard: Mapping[str, Mapping[str, Limit]] = field(default_factory=dict)

    def resolve(self, metric: str, scorecard: str | None = None) -> Limit:
        """Most specific level that names the metric; 0.0 limits when none does."""
        levels = (self.scorecard.get(scorecard or "", {}), self.model, self.default, BUILTIN_LIMITS)
        return next((level[metric] for level in levels if metric in level), Limit(0.0, 0.0))

    def metrics(self) -> set[str]:
        names = set(BUILTIN_LIMITS) | set(self.default) | set(self.model)
        return names.union(*(set(level) for level in self.scorecard.values()))


@dataclass(frozen=True)
class SampleRules:
    min_accounts_ks: int = 300
    min_bads_ks: int = 30
    min_accounts_bin: int = 50


@dataclass(frozen=True)
class Baseline:
    """``kind`` is ``fixed_window``, ``rolling_window`` or ``initial_val``."""

    kind: str = "fixed_window"
    start: str | None = None
    end: str | None = None
    months: int = 3


@dataclass(frozen=True)
class Maturity:
    label: str
    months_back: int
    edr: str
    bad: str
    flag: str
    display: str


# Outcome windows and the columns that carry them.
MATURITIES: tuple[Maturity, ...] = (
    Maturity("M3", 3, "edr30_m3", "bad30_m3", "is_mature_m3", "EDR30"),
    Maturity("M6", 6, "edr60_m6", "bad60_m6", "is_mature_m6", "EDR60"),
    Maturity("M9", 9, "edr90_m9", "bad90_m9", "is_mature_m9", "EDR90"),
    Maturity("M12", 12, "co_m12", "badco_m12", "is_mature_m12", "CO"),
)
CALIBRATION_WINDOW = "M12"


@dataclass(frozen=True)
class Attribution:
    drivers: tuple[str, ...] = ("channel", "source", "score_decile_static")
    target_maturity: str = "M9"
    max_drivers: int = 3
    min_materiality: float = 0.02


@dataclass(frozen=True)
class Monitoring:
    """Running-month monitoring over a score mart and a performance mart."""

    source: Source
    thresholds: Thresholds = Thresholds()
    baseline: Baseline = Baseline()
    sample: SampleRules = SampleRules()
    n_bins: int = 10
    ks_bins: int = 20
    intervals: tuple[tuple[float, float], ...] = tuple((i / 10, (i + 1) / 10) for i in range(10))
    risk_threshold: float = 0.5
    scorecard: str | None = None
    exclusion_flag: str = "is_excluded_from_monitoring"
    decile_col: str = "score_decile_static"
    higher_score_is_riskier: bool = True
    on_missing_maturity: str = "skip_with_note"
    backfill_months: int = 18
    backfill_min_months: int = 12
    attribution: Attribution = Attribution()
