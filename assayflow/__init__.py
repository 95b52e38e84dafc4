"""Cleaning, outlier analysis and feature preparation for measurement tables on Spark."""
