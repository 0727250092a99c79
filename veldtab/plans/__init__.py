"""Whole flows made of the operators: drift report, training, scoring."""
