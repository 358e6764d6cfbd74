"""The operators, one module per dataflow."""
