"""Operators for training data from language-model pipelines. Nothing else in the library imports this subpackage."""
