"""DataFrame-level operators: joins that survive hot keys, evidence, money, search."""
