"""DataFrame -> DataFrame operators, one module per family of the survey."""
