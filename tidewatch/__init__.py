"""Daily business-metric monitoring on Spark."""

from tidewatch.config import (
    AnomalyRules,
    ConfigError,
    GrowthModel,
    MonitorConfig,
    MonitorRegistry,
    RatioMetric,
    ScorecardLine,
    default_registry,
)
from tidewatch.plans.engine import Binding, MonitorEngine, MonitorResult, resolve_report_date
from tidewatch.plans.funnel import FunnelSource
from tidewatch.sources import ChannelMap, SqlSource

__all__ = [
    "AnomalyRules",
    "Binding",
    "ChannelMap",
    "ConfigError",
    "FunnelSource",
    "GrowthModel",
    "MonitorConfig",
    "MonitorEngine",
    "MonitorRegistry",
    "MonitorResult",
    "RatioMetric",
    "ScorecardLine",
    "SqlSource",
    "default_registry",
    "resolve_report_date",
]
