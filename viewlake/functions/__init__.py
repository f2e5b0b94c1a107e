"""Column expressions: contract rules, classifiers, bands."""
