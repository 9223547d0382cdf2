"""Message bodies: binary, text and base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farewind.functions._columns import as_column


def body_text(body: Column | str) -> Column:
    """A binary body read as UTF-8 text."""
    return as_column(body).cast("string")


def encode_body(body: Column | str) -> Column:
    """Base64 form of a body, as binary."""
    return F.base64(as_column(body).cast("binary")).cast("binary")


def decode_body(encoded: Column | str) -> Column:
    """The body behind its base64 form, as binary."""
    return F.unbase64(as_column(encoded).cast("string"))
