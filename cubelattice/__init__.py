"""cubelattice: a Spark-first engine for statistical data cubes."""
