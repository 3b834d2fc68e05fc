"""DataFrame operators: constraints, mutations, numbering, security, reports, history."""
