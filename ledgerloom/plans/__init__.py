"""Named queries, the chain view over the driver tables, and the registry."""
