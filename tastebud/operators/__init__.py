"""DataFrame operators: plain functions ``DataFrame(s) + keyword arguments -> DataFrame``."""
