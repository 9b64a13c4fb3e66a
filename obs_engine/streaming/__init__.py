from obs_engine.streaming.changes import apply_batch, fold_states, start_month_states
from obs_engine.streaming.upserts import start_weather_upsert

__all__ = ["apply_batch", "fold_states", "start_month_states", "start_weather_upsert"]
