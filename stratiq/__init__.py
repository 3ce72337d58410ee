"""A PySpark-native analytics engine for versioned, claim-centred ledgers."""
