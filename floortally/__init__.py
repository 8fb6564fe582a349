"""Retail-floor conversation and device-adherence reporting on Spark DataFrames."""

__version__ = "0.1.0"
