"""Readers: raw text or JSON in, typed columns out."""
