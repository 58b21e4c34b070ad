"""Composite plans: analysis modules, running a module by name, feature-set saving."""
