from obs_engine.plans.loading import (
    build_model,
    build_models,
    build_pending,
    commit,
    load,
    load_raw,
    loaded_days,
    open_days,
    read_model,
    refresh,
    register_views,
)
from obs_engine.plans.serving import (
    SERVING_MODELS,
    condition_count_by_month,
    condition_count_by_year,
)
from obs_engine.plans.staging import stage, unify

__all__ = [
    "SERVING_MODELS",
    "build_model",
    "build_models",
    "build_pending",
    "commit",
    "condition_count_by_month",
    "condition_count_by_year",
    "load",
    "load_raw",
    "loaded_days",
    "open_days",
    "read_model",
    "refresh",
    "register_views",
    "stage",
    "unify",
]
