"""Entity resolution over tables of different schemas, as Spark plans."""
