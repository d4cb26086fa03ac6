"""Rowsluice: onboarding, validating and loading relational data on Spark."""

from rowsluice.operators.checks import compile_check, compile_checks
from rowsluice.operators.generate import generate_rows, generate_tables
from rowsluice.operators.spec import CheckSpec, ColumnSpec, TableSpec
from rowsluice.operators.validate import ValidationFailed, Validator
from rowsluice.plans.push import LoadRefused, Source, push_plan, push_table, push_tables
from rowsluice.session import local_session
from rowsluice.sources.jsonl import read_jsonl, stream_jsonl
from rowsluice.streaming.ingest import Ingest

__all__ = [
    "CheckSpec", "ColumnSpec", "Ingest", "LoadRefused", "Source", "TableSpec",
    "ValidationFailed", "Validator", "compile_check", "compile_checks", "generate_rows",
    "generate_tables", "local_session", "push_plan", "push_table", "push_tables", "read_jsonl",
    "stream_jsonl",
]
