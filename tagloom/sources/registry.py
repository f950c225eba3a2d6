"""Label schemas, prompts and context windows as small relations."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

#: The label templates; "TODO" marks what an annotator fills in.
TEMPLATES: dict[str, dict] = {
    "recipe": {
        "type": "recipe", "name": "TODO", "description": "TODO", "author": "TODO", "prep_time": "TODO", "cook_time": "TODO",
        "total_time": "TODO", "servings": "TODO", "ingredients": ["TODO"], "instructions": ["TODO"],
    },
    "event": {
        "type": "event", "title": "TODO", "datetime": "TODO", "location": "TODO", "venue_name": "TODO", "price": "TODO",
        "organizer": "TODO", "description": "TODO", "event_type": "TODO",
    },
    "pricing_table": {
        "type": "pricing_table",
        "plans": [{"name": "TODO", "price": "TODO", "price_amount": "TODO", "currency": "TODO", "billing_period": "TODO", "features": ["TODO"], "description": "TODO"}],
    },
    "job_posting": {"type": "job_posting", "title": "TODO", "company": "TODO", "location": "TODO", "department": "TODO", "employment_type": "TODO", "description": "TODO"},
    "person": {"type": "person", "name": "TODO", "title": "TODO", "bio": "TODO", "email": "TODO", "phone": "TODO", "linkedin": "TODO"},
    "error_page": {"type": "error_page", "error_code": "TODO", "message": "TODO", "description": "TODO"},
    "auth_required": {"type": "auth_required", "message": "TODO", "description": "TODO", "content_available": False},
    "empty_shell": {"type": "empty_shell", "framework": "TODO", "content_available": False, "reason": "client_side_rendering"},
}
TYPES = tuple(TEMPLATES)

#: What the user turn of a chat example asks for, by type.
PROMPTS: dict[str, str] = {
    "recipe": "Return a JSON object with these fields: type, name, description, author, prep_time (string), cook_time (string), total_time (string), servings (string), ingredients (array), instructions (array). Use flat strings for time fields, not nested objects.",
    "job_posting": "Return a JSON object with these fields: type, title, company, location, department, employment_type, description. Use flat strings for all fields.",
    "event": "Return a JSON object with these fields: type, title, datetime (string), location, venue_name, price (string), organizer, description, event_type. Use flat strings for datetime and price fields, not nested objects.",
}
INSTRUCTION = "Extract structured data from the following HTML and return it as JSON."
HTML_MARKER = "HTML:\n"
MAX_TOKENS = 24_000
TRAIN_TOKENS = 4_096
CONTEXT_WINDOWS = (1024, 2048, 4096, 8192, 16384, 32768)
#: Annotations wanted of each type.
TARGET = 10


def prompts(spark: SparkSession) -> DataFrame:
    """type, prompt of the types that reach the chat stage; a few rows by construction."""
    return spark.createDataFrame(list(PROMPTS.items()), "type string, prompt string")


def schema_fields(spark: SparkSession) -> DataFrame:
    """type, field, kind, ordinal of every template field."""
    kinds = {str: "string", list: "array", bool: "boolean"}
    rows = [(t, f, kinds[type(v)], i) for t, fields in TEMPLATES.items() for i, (f, v) in enumerate(fields.items())]
    return spark.createDataFrame(rows, "type string, field string, kind string, ordinal int")


def type_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(TYPES)], "type string, ordinal int")


def template(kind: str) -> dict:
    """A copy of a type's template; an unknown type is an error."""
    if kind not in TEMPLATES:
        raise ValueError(f"unknown type {kind!r}; expected one of {', '.join(TYPES)}")
    return json.loads(json.dumps(TEMPLATES[kind]))
