"""Quality control of environmental sensor time series on Spark DataFrames."""

from sensorqc.series import Series

__all__ = ["Series"]
