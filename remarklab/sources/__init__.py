"""Reading comment dumps and writing stage results."""
