"""Jobs made of the operators, from input files to results."""
