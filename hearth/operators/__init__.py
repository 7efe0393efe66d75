"""Operators: DataFrame -> DataFrame functions and Spark ML stages."""
