"""Invoices rendered from the driver tables, the registered queries over them and their SQL oracles."""
