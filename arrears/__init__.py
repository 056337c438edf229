"""Loan-default analytics on Spark DataFrames: features, scoring, drift, alerts and reason codes."""
