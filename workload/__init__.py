"""The registered queries: each operator on the driver's tables, with its SQL twin."""
