"""All registered queries: importing the modules fills the registry."""

from contrail.plans import registry  # noqa: F401  (indicators and operators)
from contrail.plans import registry_io  # noqa: F401  (sources, sinks, streaming, batch run)
from contrail.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
