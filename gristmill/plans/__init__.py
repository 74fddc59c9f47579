"""The jobs: staging, feature tables, vectors, quality suites and their sequence."""
