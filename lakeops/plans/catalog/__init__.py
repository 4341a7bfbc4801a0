"""All registered queries; importing this package fills the catalogue."""

from lakeops.plans.catalog import (  # noqa: F401
    aggregates,
    changes,
    cleaning,
    functions,
    governance,
    joins,
    layout,
    loading,
    medallion,
    quality,
    sets,
    streaming,
    windows,
)
