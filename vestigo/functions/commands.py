"""The command, script or API call that an event is about.

One table says, for each relation, where its command stands: the ways in which
sources write it, in order of trust, what the result calls it, and what goes
with it. A way is a locator, of which the first that gives a text counts:

    a/b/c        the value below these keys
    a/b=X        as a/b, but the value of a parallel array beside the name X
    a/b#p        as a/b, but the texts under keys p0, p1, p2 ..., in that order
    a/b?k=v      a/b, if the text at key k of the event is v
    a/b?!k       a/b, if the event has nothing at key k
"""

from __future__ import annotations

import base64
import binascii
import re
from dataclasses import dataclass

# The suffixes of the parallel arrays' keys, the prefix of numbered words, the encoded argument and its limits.
NAMES_END, VALUES_END = "/Data/@Name", "/Data/#text"
WORD_PREFIX = "$token/"
ENCODED = re.compile(r"(?i)(?:-enc|-encodedcommand)\s+[\"']?([A-Za-z0-9+/=]{8,})")
ENCODED_CHARS, DECODED_BYTES = 65_536, 49_152
# Fixed value: why a command document was made.
COMMAND_REASON = "projected_by_m45_command_policy"


@dataclass(frozen=True)
class CommandRule:
    """``said`` names the field of the found text; without ``action`` the text itself is the action. ``beside`` and ``whole`` copy texts and any values."""

    ways: tuple[tuple[str, tuple[str, ...]], ...]
    action: str | None
    said: str | None
    beside: dict[str, tuple[str, ...]]
    whole: dict[str, str] | None = None
    decode: bool = False


# Relations, source kinds, field names and places.
RULES = {
    "ocsf_process_activity": CommandRule(
        ways=(
            ("typed_process_command", ("ocsf/process/cmd_line", "process/cmd_line", "command_line")),
            ("sysmon_command_line", ("ocsf/unmapped=CommandLine",)),
            ("bash_history_tokens", ("ocsf/unmapped#$token/",)),
            (
                "normalized_unmapped_command",
                ("ocsf/unmapped/columns/cmdline", "ocsf/unmapped/columns/command_line", "ocsf/unmapped/cmdline", "ocsf/unmapped/command_line", "ocsf/unmapped/CommandLine"),
            ),
        ),
        action="execute command",
        said="command",
        beside={"image": ("image",), "parent_image": ("parent_image",), "status": ("status",)},
        decode=True,
    ),
    "ocsf_event_log_activity": CommandRule(
        ways=(
            (
                "powershell_script_body",
                ("ocsf/unmapped/ScriptBlockText", "ocsf/unmapped/script_block", "ocsf/unmapped/script", "ocsf/unmapped/body", "ocsf/unmapped=ScriptBlockText"),
            ),
            ("powershell_4104_message", ("ocsf/message?event_id=4104",)),
        ),
        action="event log script",
        said="script",
        beside={"event_id": ("event_id",), "device": ("device",), "status": ("status",)},
    ),
    "ocsf_api_activity": CommandRule(
        ways=(("normalized_api_operation", ("operation", "ocsf/api/operation?!operation")),),
        action=None,
        said=None,
        beside={"service": ("service", "ocsf/api/service/name"), "resource": ("resource", "ocsf/resource/name"), "status": ("status", "ocsf/status")},
        whole={"request_parameters": "ocsf/unmapped/requestParameters"},
    ),
}

_LOCATOR = re.compile(r"(?P<path>[^=#?]+)(?:=(?P<name>.+)|#(?P<prefix>.+)|\?!(?P<lacks>.+)|\?(?P<key>[^=!]+)=(?P<value>.+))?")
_MISSING = object()


def value_at(event: dict, path: str) -> object:
    node: object = event
    for key in path.split("/"):
        if not isinstance(node, dict) or key not in node:
            return _MISSING
        node = node[key]
    return node


def locate(event: dict, locator: str) -> str | None:
    """The text a locator points to, or None."""
    m = _LOCATOR.fullmatch(locator)
    node = value_at(event, m["path"])
    if m["lacks"] and value_at(event, m["lacks"]) is not _MISSING:
        return None
    if m["key"]:
        return locate(event, m["path"]) if value_at(event, m["key"]) == m["value"] else None
    if m["name"] or m["prefix"]:
        if not isinstance(node, dict):
            return None
        node = _beside(node, m["name"]) if m["name"] else _numbered(node, m["prefix"])
    return node if isinstance(node, str) else None


def _beside(node: dict, wanted: str) -> object:
    arrays = [next((node[k] for k in sorted(node) if k.endswith(end)), None) for end in (NAMES_END, VALUES_END)]
    if not all(isinstance(a, list) for a in arrays):
        return None
    names = [n.lower() if isinstance(n, str) else None for n in arrays[0]]
    place = names.index(wanted.lower()) if wanted.lower() in names else len(arrays[1])
    return arrays[1][place] if place < len(arrays[1]) else None


def _numbered(node: dict, prefix: str) -> str | None:
    words = {}
    for k, v in node.items():
        number = k.removeprefix(prefix)
        if isinstance(v, str) and number != k and number.isascii() and number.isdigit():
            words.setdefault(int(number), []).append(v)
    return " ".join(w for n in sorted(words) for w in words[n]) or None


def decoded_script(command: str) -> str | None:
    """The text behind an -enc or -EncodedCommand argument: UTF-16LE if that gives clean text, else UTF-8; None if there is none."""
    m = ENCODED.search(command)
    if m is None or len(m[1]) > ENCODED_CHARS:
        return None
    try:
        raw = base64.b64decode(m[1], validate=True)
    except (binascii.Error, ValueError):
        return None
    if base64.b64encode(raw).decode() != m[1] or len(raw) > DECODED_BYTES:
        return None
    if raw and len(raw) % 2 == 0:
        wide = raw.decode("utf-16-le", "replace")
        if "�" not in wide and not re.search(r"[\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f]", wide):
            return wide
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def command_event(relation: str | None, event: dict) -> dict | None:
    """A small event that holds only what was run, called or executed, and its time; None if nothing was."""
    rule = RULES.get(relation or "")
    if rule is None:
        return None
    found = ((kind, t) for kind, places in rule.ways for p in places for t in (locate(event, p),) if t is not None)
    kind, said = next(found, (None, None))
    if kind is None:
        return None
    out: dict[str, object] = {"action": rule.action or said, "source_kind": kind}
    if rule.said:
        out[rule.said] = said
    if rule.decode and (script := decoded_script(said)) is not None:
        out["decoded_script"] = script
    for name, places in rule.beside.items():
        texts = [t for p in places for t in (locate(event, p),) if t is not None]
        if texts:
            out[name] = texts[0]
    for name, place in [*(rule.whole or {}).items(), ("time", "ocsf/time"), ("time", "time")]:
        value = value_at(event, place)
        if value is not _MISSING:
            out.setdefault(name, value)
    return out
