"""Query plans: the layered pipeline and the registered queries."""
