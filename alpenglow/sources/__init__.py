"""Where data comes in: load planning, the weather archive, landing rows, plain files."""
