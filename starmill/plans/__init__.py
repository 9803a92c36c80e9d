"""The public-health warehouse and its star-schema mart, built from the operators."""
