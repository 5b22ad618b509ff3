"""Registered queries over the driver's tables, each with the SQL it is held against where SQL can express it."""
