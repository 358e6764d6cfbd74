"""End-to-end jobs: catalog tables in, catalog tables out."""
