"""Structured Streaming wiring of the ad operators and the batch-wise tables they write."""
