"""grantlens: grant-acknowledgement analytics and corpus preparation as Spark DataFrame programs."""
