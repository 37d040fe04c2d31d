"""Reading and writing: landing envelopes, source mapping, tables."""
