"""terrapair: a PySpark-native engine for spatial matched-control studies."""
