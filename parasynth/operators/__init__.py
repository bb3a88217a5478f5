"""DataFrame operators, batch over ``source_id``."""
