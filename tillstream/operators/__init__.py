"""DataFrame operators, used unchanged on batch and streaming DataFrames unless their text says otherwise."""
