"""Sources: topic envelopes, test tables, stored metrics."""
