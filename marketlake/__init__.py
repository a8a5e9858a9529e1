"""Prediction-market analytics on PySpark: land, stage, model, check, report."""
