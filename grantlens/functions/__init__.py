"""grantlens.functions."""
