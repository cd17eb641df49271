"""tillwise: retail customer analytics (silver/gold marts, profiling, data
tests, clustering and churn models) as lazy Spark DataFrame jobs."""

__all__ = ["params", "session"]
