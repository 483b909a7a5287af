"""All registered queries; importing the modules registers them."""

from planweave.plans import battery, cases, classes, entities, links, revisions, services, spatial, statistics, takeoffs, wide, written  # noqa: F401
from planweave.plans.registry import ORACLE, QUERIES  # noqa: F401
