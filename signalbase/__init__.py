"""signalbase: landed feed snapshots to clean, resolved, deduplicated tables on Spark."""
