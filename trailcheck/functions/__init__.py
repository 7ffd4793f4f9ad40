"""Column-level helpers and composed DataFrame routines shared by operators."""
