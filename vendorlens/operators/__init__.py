"""DataFrame-in, DataFrame-out steps and analyses."""
