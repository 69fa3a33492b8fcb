"""Daily lead-to-sale KPIs and goals as Spark DataFrame jobs."""

__version__ = "0.1.0"
