"""Where data comes from and goes to."""

from tidewatch.sources.channels import MARKETING_CHANNELS, ChannelMap
from tidewatch.sources.files import load_monitor
from tidewatch.sources.roles import REVENUE_FUNNEL_ROLES, SOT_SCHEMA, as_role, read_role
from tidewatch.sources.shared import checkpoint_folder, shared
from tidewatch.sources.sinks import (
    ARCHIVE_SCHEMA,
    append_archive,
    exit_payload,
    read_archive,
    replace_in_archive,
)
from tidewatch.sources.sql import GroupedSqlSource, SqlSource, run_sql
from tidewatch.sources.store import DailyStore

__all__ = [
    "ARCHIVE_SCHEMA",
    "MARKETING_CHANNELS",
    "REVENUE_FUNNEL_ROLES",
    "SOT_SCHEMA",
    "ChannelMap",
    "DailyStore",
    "GroupedSqlSource",
    "SqlSource",
    "append_archive",
    "as_role",
    "checkpoint_folder",
    "exit_payload",
    "load_monitor",
    "read_archive",
    "read_role",
    "replace_in_archive",
    "run_sql",
    "shared",
]
