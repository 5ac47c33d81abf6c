"""Dataset views and end-to-end jobs."""
