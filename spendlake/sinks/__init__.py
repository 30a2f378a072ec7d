"""Where models are written to."""
