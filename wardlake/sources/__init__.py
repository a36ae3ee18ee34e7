"""Feed readers, table layout and streaming sources."""
