"""Draft analytics expressed as plain functions over Spark DataFrames."""
