"""Reading sources and label texts, writing code maps."""
