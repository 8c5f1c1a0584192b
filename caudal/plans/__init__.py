"""Compositions of operators: contracts, cleaning, star schema, indicators, refresh."""
