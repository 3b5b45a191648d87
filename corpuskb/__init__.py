"""corpuskb: turns raw text corpora into reviewed, deduplicated training datasets on Spark."""
