"""DataFrame operators: event count, liquidity curve, catalogue queries."""
