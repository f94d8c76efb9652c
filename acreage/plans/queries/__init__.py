"""Importing this package registers every query."""

from acreage.plans.queries import (  # noqa: F401
    batches,
    chain,
    checks,
    commits,
    conforming,
    ingest,
    loads,
    matches,
    merges,
    parcels,
    profiles,
)
