"""Named analyses over the given tables, each with the SQL that checks it where there is one."""

from momentloom.catalog import arrays, experiments, features, metrics, missing, models, ordering, profiles, resampling, search
from momentloom.catalog.registry import REGISTRY

__all__ = ["REGISTRY", "arrays", "experiments", "features", "metrics", "missing", "models", "ordering", "profiles", "resampling", "search"]
