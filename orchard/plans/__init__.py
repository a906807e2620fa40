"""End-to-end plans over the stand-in views, and their SQL oracles."""
