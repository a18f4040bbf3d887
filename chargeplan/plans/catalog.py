"""All registered queries of the engine and their SQL twins."""

from chargeplan.plans import allocation_queries, basic_queries, spatial_queries  # noqa: F401
from chargeplan.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
