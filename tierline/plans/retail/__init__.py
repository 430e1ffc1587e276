"""The order tables as a layered warehouse: one registered query per operator, with its SQL twin."""

from tierline.plans.retail import history, landing, operations, quality, reporting, series  # noqa: F401
from tierline.plans.retail.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
