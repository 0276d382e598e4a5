"""All registered queries."""

from voltmart.plans import core, inputs, models, operations, streams  # noqa: F401
from voltmart.plans.registry import ORACLES, QUERIES  # noqa: F401
