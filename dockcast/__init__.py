"""dockcast: station-availability analytics and forecasting on Spark DataFrames, SQL, ML and Streaming."""

__version__ = "0.1.0"
