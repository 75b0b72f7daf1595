"""Models built from the operators, and the runs that store and check them."""
