"""The library's operators run on the driver's tables, each with its SQL twin."""
