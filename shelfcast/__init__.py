"""shelfcast: demand-forecasting feature tables as plain Spark DataFrame jobs."""
