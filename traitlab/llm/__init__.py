"""Operators of a training-data pipeline over large text tables.

Nothing else in the library imports this subpackage.  Each operator has a
module of its own with a general interface; ``queries`` holds the registered
queries and ``oracles`` their SQL twins."""
