"""voxloom: speech-corpus preparation and evaluation as PySpark DataFrame plans."""
