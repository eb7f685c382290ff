"""Part of inkwell; see README.md."""
