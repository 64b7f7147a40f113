"""Starting, bounding and observing streaming queries."""
