"""The jobs: raw payloads to bronze, bronze to silver, silver to gold, training and serving."""
