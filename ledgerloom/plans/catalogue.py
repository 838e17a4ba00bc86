"""All queries by name, with the SQL that gives the same rows where SQL can."""

from ledgerloom.plans import chain, contracts, live, market, maths, prices, ranges, registered, tables  # noqa: F401  (they register themselves)
from ledgerloom.plans.base import ORACLES, QUERIES  # noqa: F401
