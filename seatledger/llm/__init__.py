"""Training-data operators: quality, dedup, decontamination, mixing, rendering and token files.

Nothing else in the library imports this package.
"""
