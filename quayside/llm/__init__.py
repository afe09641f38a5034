"""Training-data operators. Nothing outside this folder imports it, but for the guard in __spark_entry__."""
