"""Document loading on Spark: read mixed files, check, shape, batch, write, account."""

from docferry.operators.account import error_counts, request_errors, run_summary, success_counts
from docferry.operators.batch import assign_batches, bulk_lines, render_batches, with_row_index
from docferry.operators.validate import check_documents, enforce, objects_gate, rejected, require_all_objects
from docferry.plans.load import check_target, load_to_bulk, load_to_ndjson
from docferry.session import configure
from docferry.sinks.bulk import BulkTarget, write_bulk
from docferry.sinks.ndjson import write_ndjson
from docferry.sources.csv import read_csv_docs
from docferry.sources.files import read_documents, read_file_documents
from docferry.sources.ndjson import read_ndjson
from docferry.streaming.lines import stream_bulk, stream_ndjson

__all__ = [
    "BulkTarget",
    "assign_batches",
    "bulk_lines",
    "check_documents",
    "check_target",
    "configure",
    "enforce",
    "error_counts",
    "load_to_bulk",
    "load_to_ndjson",
    "objects_gate",
    "read_csv_docs",
    "read_documents",
    "read_file_documents",
    "read_ndjson",
    "rejected",
    "render_batches",
    "request_errors",
    "require_all_objects",
    "run_summary",
    "stream_bulk",
    "stream_ndjson",
    "success_counts",
    "with_row_index",
    "write_bulk",
    "write_ndjson",
]
