"""Domain inputs over the driver tables, registered queries and their SQL counterparts."""
