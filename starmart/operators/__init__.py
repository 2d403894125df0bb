"""DataFrame operators.  None of them reads or writes storage."""
