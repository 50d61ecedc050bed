"""Event detection, and training-data operators, on Spark."""
