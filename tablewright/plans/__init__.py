"""Declarative table builds: step chains, SQL over named inputs, runs and the warehouse."""
