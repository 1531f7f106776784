"""The star schema: code maps, dimensions, fact, model and reports."""
