"""Named queries: every entry of the registry reads a Warehouse and returns a DataFrame."""
