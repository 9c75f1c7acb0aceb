"""Logical plans: the product-history models and the driver-table stand-ins."""
