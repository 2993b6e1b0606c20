"""Sources: landing JSON (batch and stream), the driver's test tables, layers."""
