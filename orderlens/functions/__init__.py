"""Column-expression helpers: dates (``dates``) and business rules (``rules``)."""
