"""Layered (bronze, silver, gold) analytics tables as Spark DataFrame plans."""
