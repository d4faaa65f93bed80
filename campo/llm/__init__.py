"""Operators of a training-data pipeline (see README, section "Training data").

Nothing else in the library imports this subpackage."""
