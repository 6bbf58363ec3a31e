"""Panel load forecasting on Spark: cleaning, features, models, reports, streams."""

from loadweave.settings import PanelSpec, Settings

__all__ = ["PanelSpec", "Settings"]
