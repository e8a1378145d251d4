"""The jobs: silver, gold, file lifecycle and the daily run."""
