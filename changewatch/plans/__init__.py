"""Reports: each function declares one named result over the enriched changes."""
