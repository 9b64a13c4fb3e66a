from obs_engine.queries import selecting, stored, weather  # noqa: F401  (they register)
from obs_engine.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
