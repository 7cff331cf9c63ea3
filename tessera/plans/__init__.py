"""Stand-in datasets built from the driver's tables, and the registered queries."""
