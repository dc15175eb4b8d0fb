"""Named runs of the operators on the test tables, and their SQL twins."""
