"""Model wiring: which job reads which tables, and where results are written."""

from cartwheel.plans.warehouse import Warehouse, warehouse_for  # noqa: F401
