"""Query and build operators: graph and input DataFrames in, DataFrame out."""
