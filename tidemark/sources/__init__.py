"""Reading sources, landing files and the schema registry."""
