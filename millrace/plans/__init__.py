"""Named pipelines and reports; every function takes and returns DataFrames."""
