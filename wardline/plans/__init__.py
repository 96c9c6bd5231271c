"""Compositions of operators: the lake over a data folder, the query catalog, and the batch jobs."""
