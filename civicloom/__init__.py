"""Civic-data lakehouse operators: lazy DataFrame-to-DataFrame functions on Spark."""
