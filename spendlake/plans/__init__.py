"""The models, the reports on them, and the pipeline that builds them in order."""
