"""DataFrame operators. Each is a lazy plan over its inputs unless its docstring says otherwise."""
