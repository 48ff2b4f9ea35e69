"""scorewatch: monitoring of scored populations as Spark DataFrame jobs."""
