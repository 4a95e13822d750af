"""Incremental (availableNow) runs of the batch plans."""
