"""DataFrame operators: joins/filters, aggregates, change-point detectors, roll-ups."""
