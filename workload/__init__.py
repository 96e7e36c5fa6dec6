"""The registered queries: an evaluation campaign read out of the given tables."""
