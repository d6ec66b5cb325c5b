"""Warehouse jobs: each is a plain ``DataFrame(s) -> DataFrame`` function."""
