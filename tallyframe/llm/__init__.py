"""Operators for preparing training text, each as a module; ``queries.py`` registers them over the given tables."""
