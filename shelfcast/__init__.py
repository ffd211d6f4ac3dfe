"""Panel time series analytics for retail demand, expressed as Spark DataFrame transforms."""
