"""Column expressions shared by batch and streaming transforms. All run inside codegen."""
