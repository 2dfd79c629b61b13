"""Structured Streaming operators: candidate scoring (X1) and windowed drift counts."""
