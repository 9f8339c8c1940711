"""Operators for training-data pipelines. Optional: nothing else in the library imports this subpackage."""
