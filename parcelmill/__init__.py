"""Shipment mining over tables of carrier-invoice page texts, as Spark DataFrame operators."""

from parcelmill.operators.costs import cost_items
from parcelmill.operators.dates import date_candidates, with_shipment_date
from parcelmill.operators.identifiers import with_identifier
from parcelmill.operators.locations import with_locations
from parcelmill.operators.matching import dict_match
from parcelmill.operators.normalize import normalize, rejected_values
from parcelmill.operators.pages import chunk_year, invoice_year, page_lines
from parcelmill.operators.segmentation import segment
from parcelmill.operators.service import with_service
from parcelmill.operators.weights import with_weights
from parcelmill.plans.shipments import extract_shipments
from parcelmill.sources.invoice_json import invoice_json_lines, pack_invoice_json, read_invoice_files, read_invoice_json, write_invoice_json
from parcelmill.sources.pages import read_pages

__all__ = [
    "chunk_year",
    "cost_items",
    "date_candidates",
    "dict_match",
    "extract_shipments",
    "invoice_json_lines",
    "invoice_year",
    "normalize",
    "pack_invoice_json",
    "page_lines",
    "read_invoice_files",
    "read_invoice_json",
    "read_pages",
    "rejected_values",
    "segment",
    "with_identifier",
    "with_locations",
    "with_service",
    "with_shipment_date",
    "with_weights",
    "write_invoice_json",
]
