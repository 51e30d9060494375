"""Part of lumenset."""
