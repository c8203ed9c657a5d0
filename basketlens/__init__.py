"""basketlens: web-shop analytics as plain Spark DataFrame and Structured Streaming jobs.

Metric views (customer value, product performance, sales funnel), the daily
sales job, dashboard cards, data-quality checks, revenue monitoring and the
event-stream ingest are all lazy DataFrame plans; Catalyst and AQE choose the
physical strategy. Nothing is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
