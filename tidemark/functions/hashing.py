"""Content hash of a Silver row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.timefns import iso_text

# Content fields in name order.  The hash covers every non-underscore Silver
# base field; ``include_id=False`` drops event_id so equal content under
# different ids collides (the documented intent of content dedup).
CONTENT_FIELDS = (
    "actor_id", "actor_login", "created_at", "event_date", "event_hour",
    "event_id", "event_type", "payload", "repo_id", "repo_name", "repo_url",
)


def _field(name: str) -> Column:
    c = F.col(name)
    if name == "created_at":
        c = iso_text(c)
    elif name == "event_date":
        c = F.date_format(c, "yyyy-MM-dd")
    return c.alias(name)


def canonical_text(include_id: bool = True) -> Column:
    """JSON object of the content fields in name order.  Nulls are kept, text
    is quoted and the payload Variant prints its keys sorted, so different
    content never has the same text."""
    fields = [_field(f) for f in CONTENT_FIELDS if include_id or f != "event_id"]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def content_hash(include_id: bool = True) -> Column:
    return F.md5(canonical_text(include_id))
