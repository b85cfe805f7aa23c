"""Predictive-maintenance analytics on labelled sensor tables, written for Spark."""
