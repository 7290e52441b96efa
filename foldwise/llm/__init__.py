"""Operators for collections of training text. Nothing else in the library imports this subpackage."""
