"""Part of lectern."""
