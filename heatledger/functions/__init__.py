"""Part of the heat-record engine; see README.md."""
