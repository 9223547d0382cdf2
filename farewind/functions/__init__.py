"""Column expressions; every one stays in generated JVM code."""

from farewind.functions.clock import days_after, epoch_text, epoch_timestamp
from farewind.functions.codec import body_text, decode_body, encode_body
from farewind.functions.keys import hash_bucket
from farewind.functions.pricing import (
    duration_minutes,
    price_band,
    rating_delay,
    rating_preference,
)

__all__ = [
    "body_text",
    "days_after",
    "decode_body",
    "duration_minutes",
    "encode_body",
    "epoch_text",
    "epoch_timestamp",
    "hash_bucket",
    "price_band",
    "rating_delay",
    "rating_preference",
]
