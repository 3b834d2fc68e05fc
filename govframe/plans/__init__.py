"""Query recipes on the driver's tables and their independent SQL oracles."""
