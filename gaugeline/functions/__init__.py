"""Column functions: rounding, units, time parts and text keys."""
