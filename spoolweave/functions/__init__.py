"""Part of spoolweave; see README.md."""
