"""The chunk loop over files that keep arriving."""
