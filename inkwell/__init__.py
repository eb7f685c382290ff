"""Inkwell: news intake, quality control and rule scoring on Spark DataFrames."""
