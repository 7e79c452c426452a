"""Named queries over the test tables, each with its SQL twin where SQL can express it."""

from sonde.catalog import (  # noqa: F401
    aggregates, cleaning, evaluation, learning, relational, series, splitting)
from sonde.catalog.base import ORACLES, QUERIES, Tables  # noqa: F401
