"""DataFrame in, DataFrame out. Nothing here collects rows."""
