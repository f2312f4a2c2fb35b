"""DataFrame operators: parse, window, join, shape, analytics."""
