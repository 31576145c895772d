"""Delivery analytics on Spark: typed staging, daily marts, gated publishing and health checks."""
