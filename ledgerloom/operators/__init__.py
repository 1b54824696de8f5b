"""Set-oriented jobs over chain tables."""
