"""Operators of a training-data pipeline.  Nothing else in panelkit imports this package."""
