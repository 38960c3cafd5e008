"""Tick-to-candle analytics on Spark."""
