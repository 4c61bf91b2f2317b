"""Column functions over text: tokenizers, key names, redaction, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vestigo.functions.commands import ENCODED, ENCODED_CHARS


def tokens_camel(text: Column) -> Column:
    """Lower-case runs of ASCII letters, digits and underscores; a new token before an ASCII capital that follows an ASCII small letter."""
    split = F.regexp_replace(text, r"([a-z])(?=[A-Z])", "$1 ")
    return F.filter(F.split(F.lower(F.regexp_replace(split, r"[^A-Za-z0-9_]+", " ")), " "), lambda x: x != "")


def tokens_plain(text: Column) -> Column:
    """Lower-case runs of ASCII letters, digits and underscores."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, r"[^A-Za-z0-9_]+", " ")), " "), lambda x: x != "")


def tokens_camel_digit(text: Column) -> Column:
    """As ``tokens_camel``, and also a new token before a capital that follows a digit."""
    split = F.regexp_replace(text, r"([a-z0-9])(?=[A-Z])", "$1 ")
    return F.filter(F.split(F.lower(F.regexp_replace(split, r"[^A-Za-z0-9_]+", " ")), " "), lambda x: x != "")


TOKENIZERS = {"camel": tokens_camel, "plain": tokens_plain, "camel_digit": tokens_camel_digit}


def key_name(key: Column) -> Column:
    """A key in snake case: camel humps split, other characters to single underscores, none at the ends."""
    snake = F.lower(F.regexp_replace(key, r"([a-z0-9])([A-Z])", "$1_$2"))
    return F.regexp_replace(F.regexp_replace(snake, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def path_tokens(path: Column) -> Column:
    """Distinct parts of a dotted path and their pieces between underscores, sorted; list indices don't count."""
    parts = F.transform(F.split(F.regexp_replace(path, r"\[\d+\]", ""), r"\."), key_name)
    return F.array_sort(F.array_distinct(F.filter(F.concat(parts, F.flatten(F.transform(parts, lambda p: F.split(p, "_")))), lambda x: x != "")))


def bounded(text: Column, limit: int, marker: str = "…[truncated]") -> Column:
    """At most ``limit`` characters; a cut text ends in the marker."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - len(marker))), F.lit(marker))).otherwise(text)


# Redaction patterns, in the order in which they are applied.
REDACTIONS = (
    (r"(?i)(password|passwd|pwd|secret|token|api[-_]?key|access[-_]?key|authorization|cookie|private[-_]?key)(\s*(?:=|:)\s*|\s+)(\"[^\"]*\"|'[^']*'|[^\s,;]+)", "$1$2<redacted:secret>"),
    (r"(?i)\bbearer\s+[A-Za-z0-9._~+/=-]+", "Bearer <redacted:secret>"),
    (r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", "<redacted:cloud-credential>"),
    (r"(?i)\barn:[a-z0-9-]+:[^\s,;]+", "<redacted:cloud-identifier>"),
    (r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?![A-Za-z0-9_-])", "<redacted:jwt>"),
    (r"(?i)(?<![0-9a-f])(?:[0-9a-f]{2}[:-]){5}[0-9a-f]{2}(?![0-9a-f])", "<redacted:mac-address>"),
    (r"(?i)(?<![\w.+-])[\w.+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![\w.-])", "<redacted:email-address>"),
    (r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w.])", "<redacted:ip-address>"),
    (r"(?i)(?<![0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}(?![0-9a-f])", "<redacted:uuid>"),
    (r"(?i)(?<![0-9a-f])[0-9a-f]{32,}(?![0-9a-f])", "<redacted:long-identifier>"),
)


def _unicode(pattern: str) -> str:
    """The same pattern with \\w, \\d, \\s, \\b and letter case by Unicode, as in the row-wise rules."""
    return "(?U)" + pattern


def sanitize(text: Column, limit: int | None = 240) -> Column:
    """Free text without control breaks, secrets and identifiers, white space collapsed; bounded, or whole if the limit is None."""
    out = F.regexp_replace(text, r"[\x00\r\n]", " ")
    for pattern, to in REDACTIONS:
        out = F.regexp_replace(out, _unicode(pattern), to)
    out = F.trim(F.regexp_replace(out, _unicode(r"\s+"), " "))
    return out if limit is None else bounded(out, limit)


def holds_credential(text: Column) -> Column:
    """Whether a text shows an assigned secret, a bearer or access key, or a three-part token."""
    hit = F.lit(False)
    for pattern, _ in (*REDACTIONS[:3], REDACTIONS[4]):
        hit = hit | text.rlike(_unicode(pattern))
    return hit


def magnitude_bucket(value: Column) -> Column:
    """'zero' or [negative-]1eN with N the integer digits less one; of a whole number."""
    digits = F.length(F.abs(value).cast("string")) - 1
    return F.when(value == 0, "zero").otherwise(F.concat(F.when(value < 0, "negative-").otherwise(""), F.lit("1e"), digits.cast("string")))


def port_bucket(port: Column) -> Column:
    return (
        F.when(~port.between(0, 65535), "<port:invalid>")
        .when(port < 1024, F.concat(F.lit("<port:privileged:"), port.cast("string"), F.lit(">")))
        .when(port < 49152, "<port:registered>")
        .otherwise("<port:dynamic>")
    )


def power_bucket(n: Column) -> Column:
    """'0' or the 'lower-upper' label of the power of two that a count falls in."""
    bits = F.length(F.bin(n.cast("long")))
    low = F.pow(F.lit(2), bits - 1).cast("long")
    return F.when(n <= 0, "0").otherwise(F.concat(low.cast("string"), F.lit("-"), (low * 2 - 1).cast("string")))


def epoch_seconds(value: Column) -> Column:
    """Seconds of an epoch number in s, ms, us or ns, by its magnitude."""
    size = F.abs(value)
    return (
        F.when(size >= 1e17, value / F.lit(1e9)).when(size >= 1e14, value / F.lit(1e6)).when(size >= 1e11, value / F.lit(1e3)).otherwise(value.cast("double"))
    )


def decode_script(command: Column) -> Column:
    """The column twin of ``commands.decoded_script``."""
    coded = F.regexp_extract(command, ENCODED.pattern, 1)
    raw = F.when((coded != "") & (F.length(coded) <= ENCODED_CHARS), F.try_to_binary(coded, F.lit("base64")))
    wide = F.when(F.octet_length(raw) % 2 == 0, F.try_validate_utf8(F.decode(raw, "UTF-16LE")))
    clean = wide.isNotNull() & ~wide.rlike(r"[\x00-\x08\x0e-\x1f\x7f-\x9f�]")
    return F.when(clean, wide).otherwise(F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8")))


def xml_field(xml: Column, name: str) -> Column:
    """The text of the first Data element with that Name in an event's XML; null if there is none. Namespaces don't matter."""
    if "'" in name:
        raise ValueError("a field name can't hold an apostrophe")
    return F.get(F.xpath(xml, F.lit(f"//*[local-name()='Data'][@Name='{name}']/text()")), F.lit(0))
