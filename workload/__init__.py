"""The library bound to the driver's tables: sources, layers, queries and their SQL."""
