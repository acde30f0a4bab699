"""The library's operators on the driver's tables, and their SQL."""
