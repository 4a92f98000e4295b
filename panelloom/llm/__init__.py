"""Operators for training-data corpora: tokens, languages, duplicates, fingerprints, scans."""
