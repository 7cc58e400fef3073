"""Where messages and results are written to."""
