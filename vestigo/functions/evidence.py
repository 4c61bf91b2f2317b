"""Small functions around evidence: categories, safe rendering, digests, templates, test vectors."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from vestigo.functions.text import magnitude_bucket

# States and graph terms that may be shown as they are.
STATES = """active allowed blocked closed compliant created deleted denied disabled enabled failed inactive noncompliant
open private public running stopped success unknown""".split()
ENTITY_KINDS = "account application credential datastore device file identity network_endpoint process resource service session".split()
PARTICIPANT_ROLES = "actor device object observer owner principal recipient resource sender source subject target".split()


def iso_millis(ms: Column) -> Column:
    """UTC text with milliseconds and Z."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def state_category(text: Column, kind: Column) -> Column:
    """A state's generic category: known words as they are, else only what kind of value it is."""
    word = F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"[-\s]+", " ")), " ", "_")
    whole = text.rlike(r"^-?\d{1,18}$")
    return (
        F.when(text.isNull(), "null-state")
        .when(kind == "boolean", F.lower(text))
        .when((kind == "number") & whole, F.concat(F.lit("numeric-"), magnitude_bucket(text.try_cast("long"))))
        .when(kind == "number", "numeric-state")
        .when(kind == "list", "list-state")
        .when(kind == "object", "object-state")
        .when(word.isin(STATES), word)
        .otherwise("string-state")
    )


def closed_term(value: Column, allowed: list[str], family: str) -> Column:
    """A term of a closed vocabulary, or the redaction that names its family."""
    return F.when(value.isin(allowed), F.replace(value, F.lit("_"), F.lit(" "))).otherwise(F.lit(f"<redacted:{family}>"))


def tagged(value: Column) -> Column:
    """Absent and present values told apart."""
    return F.struct(F.when(value.isNull(), "absent").otherwise("present").alias("state"), value.cast("string").alias("value"))


def set_digest(*member: Column) -> Column:
    """An aggregate over distinct members: SHA-256 of their number and of two sums of their hashes.

    Sums don't depend on order and combine in each split, so a set of any size
    never has to be gathered.
    """
    a = F.sum(F.xxhash64(*member).cast("decimal(38,0)"))
    b = F.sum(F.xxhash64(F.lit("second"), *member).cast("decimal(38,0)"))
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), a.cast("string"), b.cast("string")), 256)


def fill_template(template: str, **values: str) -> str:
    """A text with each named placeholder, which must stand exactly once, filled in; values aren't searched for placeholders."""
    marks = sorted((template.index("{" + k + "}"), k) for k in values if template.count("{" + k + "}") == 1)
    rest = template
    for k in values:
        rest = rest.replace("{" + k + "}", "")
    if len(marks) != len(values) or "{" in rest or "}" in rest:
        raise ValueError("each placeholder must stand exactly once, and no other may")
    out, at = [], 0
    for i, k in marks:
        out += [template[at:i], values[k]]
        at = i + len(k) + 2
    return "".join([*out, template[at:]])


def test_vector(key: str, dimensions: int = 4096, nonzero: int = 16) -> list[float]:
    """A unit vector drawn from a hash of the key: ``nonzero`` entries of equal size and hashed sign."""
    out, counter = {}, 0
    while len(out) < min(nonzero, dimensions):
        block = hashlib.sha256(f"{key}:{counter}".encode()).digest()
        for i in range(0, 32, 4):
            raw = int.from_bytes(block[i : i + 4], "little")
            out.setdefault((raw >> 1) % dimensions, 1.0 if raw & 1 else -1.0)
            if len(out) == nonzero:
                break
        counter += 1
    size = len(out) ** -0.5
    return [out.get(i, 0.0) * size for i in range(dimensions)]
