"""Query catalogue of the driver contract."""
