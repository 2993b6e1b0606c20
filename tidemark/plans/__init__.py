"""Composed plans: Silver/Gold layers, incremental runs, sinks, export,
run health, and the query catalog registered with the driver."""
