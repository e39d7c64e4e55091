"""DataFrame operators: lazy unless their docstring says otherwise, and free of fixed paths."""
