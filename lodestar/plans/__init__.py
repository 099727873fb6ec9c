from lodestar.plans import survey, warehouse
from lodestar.plans.fixtures import Fixtures

__all__ = ["Fixtures", "survey", "warehouse"]
