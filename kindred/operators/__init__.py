"""The steps of record linkage as functions from frames to frames."""
