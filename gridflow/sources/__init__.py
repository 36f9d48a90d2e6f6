"""Readers. Each returns a batch or a streaming DataFrame and does nothing else."""
