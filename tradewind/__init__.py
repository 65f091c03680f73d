"""Retail real-time warehouse and risk rules, expressed as Spark jobs."""
