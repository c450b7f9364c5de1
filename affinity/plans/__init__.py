"""Query plans: the binding of the driver tables to the analyses' inputs,
the registered queries and their SQL oracles."""
