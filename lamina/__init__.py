"""lamina: DataFrame operators for layered analytics on Spark."""

from lamina.context import RunContext
from lamina.runtime import tune
from lamina.settings import Settings, from_mapping, from_yaml

__all__ = ["RunContext", "Settings", "from_mapping", "from_yaml", "tune"]
