"""DataFrame-to-DataFrame operators; every function is lazy and free of side effects."""
