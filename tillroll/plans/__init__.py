"""Composed plans: the testdata star adapter, the batch job, the query catalog."""
