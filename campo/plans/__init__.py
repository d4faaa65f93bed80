"""Named queries over the test tables (Spark side) and their SQL oracles."""
