"""Compositions of the operators: layers, dimensions, fact, whole runs and reports."""
