"""Declarative reports and metadata dataflow on Spark DataFrames."""
