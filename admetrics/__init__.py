"""DataFrame operators for advertising-performance data on Spark."""
