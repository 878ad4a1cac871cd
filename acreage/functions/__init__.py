"""Column expressions shared by batch, streaming and serving jobs."""
