"""Panel time-series analytics and forecasting on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from panelwright.spec import SeriesSpec

# Functions run on executors travel with the job, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["SeriesSpec"]
