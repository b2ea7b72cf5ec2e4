from .monthly import loan_summary, monthly_customer_report, service_activity
from .orders import (
    customers_in_cities,
    customers_with_orders,
    order_totals,
    orders_in_value_range,
    products_above_average,
)
from .readiness import (
    blocked_dependencies,
    expected_runs,
    input_readiness,
    logged_span,
    missing_inputs,
    require_ready,
)
from .registry import Registry, registry
from .reports import REPORTS, run_report
from .runner import apply_steps, read_config, require, run

__all__ = [
    "REPORTS",
    "Registry",
    "apply_steps",
    "blocked_dependencies",
    "customers_in_cities",
    "customers_with_orders",
    "expected_runs",
    "input_readiness",
    "loan_summary",
    "logged_span",
    "missing_inputs",
    "monthly_customer_report",
    "order_totals",
    "orders_in_value_range",
    "products_above_average",
    "read_config",
    "registry",
    "require",
    "require_ready",
    "run",
    "run_report",
    "service_activity",
]
