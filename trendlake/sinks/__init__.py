"""Writing tables and raw documents."""
