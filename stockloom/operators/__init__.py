"""DataFrame-to-DataFrame building blocks of the warehouse."""
