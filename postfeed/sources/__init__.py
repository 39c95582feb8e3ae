"""Reading and writing posting tables, feeds and request logs."""
