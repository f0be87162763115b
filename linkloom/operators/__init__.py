"""operators of the linkage engine."""
