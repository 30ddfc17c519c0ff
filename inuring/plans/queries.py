"""All queries of the engine: importing the modules registers them."""

from inuring.plans import engine, scans  # noqa: F401
from inuring.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
