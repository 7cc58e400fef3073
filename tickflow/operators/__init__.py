"""DataFrame-to-DataFrame steps; none of them brings unbounded data to the driver."""
