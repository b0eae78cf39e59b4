"""DataFrame operators: status, merge, derived facts, identity, quality."""
