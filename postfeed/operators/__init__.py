"""DataFrame operators: lazy, DataFrame in, DataFrame out."""
