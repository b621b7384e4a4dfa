"""Structured Streaming jobs: windowed monitoring and live labelling."""
