"""City mobility, permit and health analytics as DataFrame operators on Spark."""

from wardline.config import Bounds, Settings

__all__ = ["Bounds", "Settings"]
__version__ = "0.1.0"
