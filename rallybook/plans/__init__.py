"""Layer builders made of the operators, and the pipeline that runs them."""
