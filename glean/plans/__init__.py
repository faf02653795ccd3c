"""Query plans: driver tables, fixture views, branch compositions, registry."""
