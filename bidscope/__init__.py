"""Auction analytics on Spark: offers -> features -> winner models -> repricing."""
