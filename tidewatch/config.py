"""Monitor configuration: frozen dataclasses, a registry and its checks.

Configuration lives on the driver and is never a DataFrame. Adding a monitor means
registering one more :class:`MonitorConfig` and binding a source to it; no operator
has to change.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

COMPARISON_DAYS = {"wow": 7, "yoy": 364}
"""Day offset of each comparison; 364 keeps the weekday."""

LOOKBACK_WITH_YOY = 380
LOOKBACK_WITHOUT_YOY = 21


class ConfigError(ValueError):
    """A monitor definition that cannot be run."""


@dataclass(frozen=True)
class RatioMetric:
    """``numerator / denominator``; ``direction`` says which way is good."""

    key: str
    label: str
    numerator: str
    denominator: str
    direction: str = "up"

    def __post_init__(self) -> None:
        if self.direction not in ("up", "down"):
            raise ConfigError(f"metric {self.key!r}: direction must be 'up' or 'down'")


@dataclass(frozen=True)
class AnomalyRules:
    """A move is flagged when ``abs(yoy) > yoy_threshold``; small denominators are ignored."""

    yoy_threshold: float = 0.10
    min_denominator: float = 50


@dataclass(frozen=True)
class GrowthModel:
    """Columns of the identity ``revenue = visitors * conversion * monetization``."""

    visitors: str = "intentful_visitors"
    orders: str = "projects"
    revenue: str = "revenue"


@dataclass(frozen=True)
class ScorecardLine:
    """One row of the scorecard; ``style`` is ``count``, ``money`` or ``ratio``."""

    column: str
    label: str
    style: str = "count"


@dataclass(frozen=True)
class MonitorConfig:
    """Everything the engine needs to know about one monitor."""

    key: str
    name: str
    dimensions: tuple[str, ...]
    metrics: tuple[RatioMetric, ...]
    volume_metrics: tuple[str, ...] = ()
    rules: AnomalyRules = AnomalyRules()
    comparisons: tuple[str, ...] = ("wow",)
    context: str = ""
    title: str = ""
    sot_columns: Mapping[str, str] = field(default_factory=dict)
    scorecard: tuple[ScorecardLine, ...] = ()
    growth: GrowthModel | None = None

    def __post_init__(self) -> None:
        if not self.dimensions:
            raise ConfigError(f"monitor {self.key!r} has no dimension level")
        unknown = set(self.comparisons) - set(COMPARISON_DAYS)
        if unknown:
            raise ConfigError(f"monitor {self.key!r}: unknown comparison {sorted(unknown)}")
        if self.growth and "yoy" not in self.comparisons:
            # Growth is year over year: without that comparison there are no growth sections.
            object.__setattr__(self, "growth", None)
        if self.growth and not any(
            (m.numerator, m.denominator) == (self.growth.revenue, self.growth.orders)
            for m in self.metrics
        ):
            raise ConfigError(f"monitor {self.key!r}: a growth model needs its revenue per order")
        for what, names in (
            ("metric", [m.key for m in self.metrics] + list(self.volume_metrics)),
            ("dimension", list(self.dimensions)),
        ):
            repeated = {n for n in names if names.count(n) > 1}
            if repeated:
                raise ConfigError(f"monitor {self.key!r}: repeated {what} {sorted(repeated)}")

    @property
    def lookback_days(self) -> int:
        """Length of the pull before the report day."""
        return LOOKBACK_WITH_YOY if "yoy" in self.comparisons else LOOKBACK_WITHOUT_YOY

    @property
    def offsets(self) -> dict[str, int]:
        """Comparison name to day offset, in the fixed order wow, yoy."""
        return {name: days for name, days in COMPARISON_DAYS.items() if name in self.comparisons}

    def compared_columns(self, available: list[str]) -> list[str]:
        """Metric and volume columns the frame really has."""
        wanted = [m.key for m in self.metrics] + list(self.volume_metrics)
        return [c for c in wanted if c in available]

    @classmethod
    def from_dict(cls, key: str, raw: Mapping) -> MonitorConfig:
        """Build a monitor from a plain nested mapping, such as parsed JSON."""
        try:
            metrics = tuple(RatioMetric(key=k, **dict(v)) for k, v in raw.get("metrics", {}).items())
            return cls(
                key=key,
                name=raw["name"],
                dimensions=tuple(raw["dimensions"]),
                metrics=metrics,
                volume_metrics=tuple(raw.get("volume_metrics", ())),
                rules=AnomalyRules(**raw.get("anomaly_rules", {})),
                comparisons=tuple(raw.get("comparison", ("wow",))),
                context=raw.get("context", ""),
                title=raw.get("title", ""),
                sot_columns=dict(raw.get("sot_columns", {})),
                scorecard=tuple(ScorecardLine(**dict(s)) for s in raw.get("scorecard", ())),
                growth=GrowthModel(**raw["growth"]) if "growth" in raw else None,
            )
        except (KeyError, TypeError) as error:
            raise ConfigError(f"monitor {key!r}: {error}") from error


class MonitorRegistry(Mapping[str, MonitorConfig]):
    """Monitors by key, in the order they were registered."""

    def __init__(self, *monitors: MonitorConfig) -> None:
        self._monitors: dict[str, MonitorConfig] = {}
        for monitor in monitors:
            self.register(monitor)

    def register(self, monitor: MonitorConfig) -> MonitorConfig:
        if monitor.key in self._monitors:
            raise ConfigError(f"monitor {monitor.key!r} is already registered")
        self._monitors[monitor.key] = monitor
        return monitor

    def __getitem__(self, key: str) -> MonitorConfig:
        return self._monitors[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._monitors)

    def __len__(self) -> int:
        return len(self._monitors)


def parse_keys(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    """Monitor keys from a comma list, blanks trimmed."""
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    return [p.strip() for p in parts]


# Metric keys, labels, columns, directions and rules of the shipped monitor.
REVENUE_FUNNEL = MonitorConfig(
    key="revenue_funnel",
    name="Revenue Funnel Daily Monitor",
    title="Daily Revenue Funnel",
    dimensions=("overall", "channel"),
    metrics=(
        RatioMetric("iv_to_request", "Requests per Intentful Visitor", "requests", "intentful_visitors"),
        RatioMetric("ppr", "Projects per Request (PPR)", "projects", "requests"),
        RatioMetric("rpp", "Revenue per Project (RPP)", "revenue", "projects"),
        RatioMetric("cpp", "Contacts per Project (CPP)", "contacts", "projects"),
        RatioMetric("rpc", "Revenue per Contact (RPC)", "revenue", "contacts"),
    ),
    volume_metrics=("intentful_visitors", "requests", "projects", "contacts", "revenue"),
    rules=AnomalyRules(yoy_threshold=0.10, min_denominator=50),
    comparisons=("wow", "yoy"),
    context=(
        "Daily health of the path from visit to revenue. Revenue splits into visitor traffic, "
        "conversion of visitors into projects, and revenue per project; year-over-year growth is "
        "the main comparison, with a breakdown by acquisition channel."
    ),
    sot_columns={
        "intentful_visitors": "total_iv",
        "requests": "total_requests",
        "projects": "total_projects",
        "revenue": "total_revenue",
    },
    scorecard=(
        ScorecardLine("intentful_visitors", "Intentful Visitors", "count"),
        ScorecardLine("requests", "Requests", "count"),
        ScorecardLine("projects", "Projects", "count"),
        ScorecardLine("revenue", "Revenue", "money"),
        ScorecardLine("rpp", "RPP", "money"),
        ScorecardLine("ppr", "PPR", "ratio"),
    ),
    growth=GrowthModel(),
)


def default_registry() -> MonitorRegistry:
    """A fresh registry holding the shipped monitor."""
    return MonitorRegistry(REVENUE_FUNNEL)
