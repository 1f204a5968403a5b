"""Per-seller monthly feature tables and batch scoring, built as Spark plans."""

from .plans.abt import FeaturePlan, build_abt, build_abt_range, read_abt, write_abt
from .sources.roles import Roles, driver_roles, read_roles

__all__ = ["FeaturePlan", "Roles", "build_abt", "build_abt_range", "driver_roles", "read_abt",
           "read_roles", "write_abt"]
