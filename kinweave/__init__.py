"""Entity resolution and record linkage as composable DataFrame operations."""
