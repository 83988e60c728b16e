"""Tessera: aligning, assembling and checking large text collections on Spark."""
