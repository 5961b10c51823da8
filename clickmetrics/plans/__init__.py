"""Whole runs: which metrics are built from what, and what a dashboard reads."""

from clickmetrics.plans.dashboard import DashboardPartError, dashboard_records, dashboard_snapshot
from clickmetrics.plans.profiles import (
    SQL_RUN,
    run_local_profile,
    run_metrics,
    run_warehouse_profile,
    verify_events,
)
from clickmetrics.plans.rollup import current_activity, refresh_rollup, run_rollup
from clickmetrics.plans.user_state import (
    UserState,
    current_totals,
    refresh_user_state,
    stored_state,
)

__all__ = [
    "SQL_RUN",
    "DashboardPartError",
    "UserState",
    "current_activity",
    "current_totals",
    "dashboard_records",
    "dashboard_snapshot",
    "refresh_rollup",
    "refresh_user_state",
    "run_local_profile",
    "run_metrics",
    "run_rollup",
    "run_warehouse_profile",
    "stored_state",
    "verify_events",
]
