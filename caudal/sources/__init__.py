"""Reading landed data and writing layers."""
