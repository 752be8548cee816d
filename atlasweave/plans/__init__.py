"""The clean, assess and match pipelines."""
