"""Millrace: medallion pipelines and warehouse reports written for Apache Spark."""
