"""Operators: DataFrame(s) in, DataFrame out; no actions inside but for the checkpoint in ``ranking``."""
