"""The load step over new landing files only."""
