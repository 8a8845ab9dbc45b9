"""hemline: daily retail analytics (bronze -> silver -> gold) as Spark DataFrame jobs."""
