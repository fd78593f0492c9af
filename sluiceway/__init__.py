"""Dataflow operators for tables and streams, written as Spark DataFrame plans."""
