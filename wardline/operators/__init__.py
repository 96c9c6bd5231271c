"""DataFrame-in, DataFrame-out operators. None of them reads the clock."""
