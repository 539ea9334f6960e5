"""Operators put together: the batch chain and the registered queries."""
