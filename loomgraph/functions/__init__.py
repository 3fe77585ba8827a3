"""Scalar functions: identities, terms, references, times."""
