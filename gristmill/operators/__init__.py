"""Operators over whole frames: de-duplication, upserts, checks, profiles, embedding, retrieval."""
