"""grantlens.operators."""
