"""Feature tables, model data sets and the jobs built from the operators."""
