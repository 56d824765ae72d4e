"""Queries over the driver's tables, one per operator, each with its SQL twin where SQL can say it."""
