"""Training-data operators: thirteen numbered operators over ``documents`` and their
queries. Nothing else in the library imports this subpackage."""
