"""souk — marketplace order analytics on Spark (DataFrame API)."""
