"""DataFrame-in, DataFrame-out operators, for use with ``df.transform``."""
