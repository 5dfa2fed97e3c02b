"""seriesforge: sensor-series features, forecasts and insights as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from seriesforge.config import FeatureConfig, SeriesSpec

# Functions sent to Python workers carry their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FeatureConfig", "SeriesSpec"]
__version__ = "0.1.0"
