"""Registered queries, their SQL counterparts, and the views both run on."""
