"""Whole passes composed of operators, and the registered queries."""
