"""The registered queries, their SQL equivalents, and what both run on."""
