"""Credit-policy analytics on Spark: clean loan tables, backtest approval policies, watch drift."""
