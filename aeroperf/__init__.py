"""Operational-performance and event-record analytics on Spark DataFrames."""
