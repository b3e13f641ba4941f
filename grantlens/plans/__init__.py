"""grantlens.plans."""
