"""Retail sales layers (Bronze, Silver, Gold) built with the Spark DataFrame API."""
