"""Incremental extraction by cursor: each run reads what came after the stored watermark."""
