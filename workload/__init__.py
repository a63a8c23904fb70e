"""The pipeline applied to the TPC-H-like driver tables, with its SQL oracle."""
