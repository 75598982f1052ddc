"""Table transformations: DataFrame in, DataFrame out."""
