"""Governed medallion analytics on Spark DataFrames."""
