"""daybook: daily store-performance reporting on PySpark.

Every operator takes and returns DataFrames; jobs live in ``daybook.plans``.
"""

from daybook.functions.clock import RunClock
from daybook.operators.audit import AuditLog
from daybook.plans.ops_goals import OpsAccounts, OpsSources, load_ops_goals, run_ops_goals
from daybook.plans.revenue import RevenueParams, RevenueSources, load_revenue, run_revenue

__all__ = ["RunClock", "AuditLog", "RevenueParams", "RevenueSources", "run_revenue", "load_revenue",
           "OpsAccounts", "OpsSources", "run_ops_goals", "load_ops_goals"]
