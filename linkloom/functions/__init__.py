"""functions of the linkage engine."""
