"""Operators of a training-data pipeline (see README); nothing else in the library imports them."""
