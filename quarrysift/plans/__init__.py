"""Multi-step jobs: the index, the grep run and the diagnostics."""
