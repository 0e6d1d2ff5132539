"""Composed jobs: the call graph derived from the driver tables, feature
tables, activity features, profiles and model training."""
