"""The three data flows (prepare, evaluate, preference) and the registered queries."""
