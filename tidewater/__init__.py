"""Equity analytics and corpus operators on Spark."""
