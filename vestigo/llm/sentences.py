"""Sentence units of texts in many languages and scripts.

A semi-Markov dynamic programme picks whole spans. Every place where a unit
could end gets a score from its closing words (end mark, abbreviation, number,
initial) and from the opening words after it; a span adds terms for its length
and for the quotation or bracket it may consist of; ends within a quotation or
bracket that is closed later are refused. Places whose score no span term can
outweigh are fixed first, which cuts the text into short independent problems
without changing the optimum.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Abbreviations that never end a sentence.
NEVER = frozenset(
    """adm al anm approx aprox art art bd bes betr bspw bzgl bzw ca cap cf cfr ch col dipl dir doc dr dra e.g ed eds eig
    env etw ev ex exmo fig figs fr gen ggf gov hon hr i.e ing insb inkl jan feb mar apr jun jul aug sep sept oct nov dec
    lic lt m max mme mlle mgr mr mrs ms mt n.b no nos nr num obs op p pag pág pp prof resp rev s.o sec secc sen sgt sig
    sog sr sra srta st sta ste tab tel ud uds univ v vgl vol vs z zzgl д-р др им ок проф рис см стр ст тел тыс ул напр
    abs abb allg i.d.r o.ä u.a z.b d.h p.ej ej डॉ श्री प्रो""".split()
)
# Abbreviations and units that can stand inside a sentence or at its end.
EITHER = frozenset(
    """a.m p.m u.s u.k e.u inc etc usw co corp ltd llc plc kg ag gmbh s.a s.l s.r.l jr h s min sek std yrs yr hrs hr mins
    secs wk wks mo mos oz lb lbs ft km cm mm ч г гг в вв д п т.д т.п т.е руб млн млрд ggü uhr j.c""".split()
)
# Words that continue a company name after its first part.
COMPANY_TAIL = frozenset("KG KGaA OHG Ltd Inc LLC".split())
# Words before, and month names after, a written ordinal such as "2.".
ORDINAL_BEFORE = frozenset(
    "der die das dem den des am im vom zum zur beim ab bis seit dieser diese dieses jeder jede jedes ein eine einen einem einer und ihr ihre sein seine".split()
)
MONTHS = frozenset(
    """januar jänner februar märz april mai juni juli august september oktober november dezember januars""".split()
)
# End marks, opening and closing quotes and brackets.
MARKS = ".!?…‥。！？．｡।॥؟۔‽⁇⁈⁉՞։።፧"
FULL_MARKS = "。！？．｡"
CLOSERS = "\"'”’»›“‘)]}」』）】〉》］"
QUOTE_PAIRS = {"“": "”", "„": "“”", "‚": "‘’", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", "【": "】", "《": "》", "»": "«"}
OPENERS = "“„‚«‹「『([（【《¿¡"
#: Opening characters by the closing ones.
CLOSES = {c: "".join(o for o, ends in QUOTE_PAIRS.items() if c in ends) for ends in QUOTE_PAIRS.values() for c in ends}
#: A score no span term can outweigh.
FIXED = 4.0

_BLANK_LINE = re.compile(r"\n[^\S\n]*(?=\n)(?:\n[^\S\n]*)*")
_BULLET = re.compile(r"(?:(?<=\n)|\A)[^\S\n]*(?:[-*•·▪◦‣]|\(?(\d{1,3})[.)])(?=[^\S\n])")
_ITEM = re.compile(r"(?:[-*•·▪◦‣]|\(?\d{1,3}[.)])(?=[^\S\n])")
_PLACE = re.compile(rf"[{re.escape(MARKS)}]+(?:\s?»|[{re.escape(CLOSERS)}])*")
_THAI_BLANK = re.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")
_PAIR_CHARS = re.compile(r"[“”„‚‘’«»‹›「」『』()\[\]（）【】《》]")
_WORD = re.compile(r"\S+")
_IDENTIFIER = re.compile(r"[^\W\d_]+(?:[-._]|\d)[\w.\-]*\w")
_SECOND = re.compile(r"\S+\s+(\S+)")


def _cased(c: str) -> bool:
    return c.isupper() or c.islower()


def _bare(word: str) -> str:
    """A word without invisible characters, opening marks and its final dots, composed and in lower case."""
    word = word.replace("\xad", "").replace("​", "").lstrip("".join(QUOTE_PAIRS) + "\"'¿¡").rstrip(".")
    return unicodedata.normalize("NFC", word).lower()


def _pairs(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Matched quotes and brackets as (open, close), and close -> open; however far apart, each character is put and taken once."""
    stack: list[tuple[int, str]] = []
    places: dict[str, list[int]] = {c: [] for c in QUOTE_PAIRS}  # in the stack, by character
    found: list[tuple[int, int]] = []
    for m in _PAIR_CHARS.finditer(text, start, end):
        c, at = m[0], m.start()
        k = max((places[o][-1] for o in CLOSES.get(c, "") if places[o]), default=-1)
        if k >= 0:
            found.append((stack[k][0], at))
            while len(stack) > k:
                places[stack.pop()[1]].pop()
        elif c in QUOTE_PAIRS and c != "»":
            places[c].append(len(stack))
            stack.append((at, c))
    return found, {b: a for a, b in found}


def _opens(text: str, at: int, end: int) -> str:
    """How the words after a possible end begin: upper, quote, digit, plain, name, caseless, goes_on or other."""
    c = text[at]
    if c in OPENERS:
        return "quote"
    if c in ",;:—–，；：、%％/":
        return "goes_on"
    if c.isdigit():
        return "digit"
    if not c.isalpha():
        return "quote" if c in "\"'" else "other"
    if c.isupper():
        return "upper"
    if not c.islower():
        return "caseless"
    word = _WORD.match(text, at, end)[0]
    if word in ("cf.", "ca.", "e.g.", "i.e.", "z.") or _IDENTIFIER.match(word):
        return "name"
    # a word in lower case is a name and the subject of a new sentence if a past tense or another script follows; behind a quotation that tells "x.exe stopped" from "asked the lead"
    second = _SECOND.match(text, at, min(end, at + 120))
    if second:
        s = second[1]
        if s[0].isalpha() and not _cased(s[0]) or len(s) > 4 and s.rstrip(",").endswith("ed") and len(word) > 3:
            return "name"
    return "plain"


def _close_score(text: str, start: int, at: int, cut: int, stop: int, follow: int, end: int) -> float:
    """Score of an end from its closing and opening words alone.

    End marks are text[at:cut], closing quotes and brackets text[cut:stop];
    the next words begin at ``follow``, and words before ``start`` don't count.
    """
    marks, closers = text[at:cut], text[cut:stop].strip()
    gap = follow > stop
    opens = _opens(text, follow, end)
    if opens == "goes_on":
        return -8.0
    before = text[at - 1] if at > start else " "
    full = any(c in FULL_MARKS for c in marks)
    dots = not full and ("…" in marks or "‥" in marks or marks.count(".") > 1) and "!" not in marks and "?" not in marks
    if not gap:
        c = text[follow]
        if closers and ("぀" <= c <= "ゟ" or "가" <= c <= "힣"):
            return -8.0  # a particle that quotes what was said
        path = any(x in (text[max(start, at - 60) : at].split()[-1:] or [""])[0] for x in "/\\@")
        if dots:
            return 2.5 if opens in ("upper", "quote", "name") or opens == "caseless" and (_cased(before) or before.isdigit()) else -8.0
        if full or marks[0] in "।॥؟۔":
            return 6.0
        if opens == "quote" and text[follow] not in "([\"'":
            return 5.0
        if opens == "upper":
            word = text[max(start, at - 60) : at].split()[-1:] or [""]
            if any(x in word[0] for x in "\\@") and before != "/" or before == " ":
                return -8.0
            nxt = text[follow + 1 : follow + 2]
            if not (nxt.islower() or nxt.isspace()) or not (closers or before.islower() or before.isdigit() or before in ")%" or not _cased(before) and before.isalpha()):
                return -8.0
            return -8.0 if marks == "." and _bare(word[0]) in NEVER else 5.0
        if opens == "caseless" and (closers or before.isalnum() or before in ")%") and not path:
            return 5.0
        if opens == "name" and (closers or marks[-1] in "!?") and not path:
            return 4.0
        return -8.0
    if closers and closers.strip(")]}") and opens == "plain":
        return -8.0
    if dots:
        return {"plain": -4.0, "other": -4.0}.get(opens, 2.5)
    score = {"plain": 2.0, "digit": 5.0, "name": 5.0, "other": 1.0}.get(opens, 6.0)
    if closers and closers[-1] in ")]}" and opens == "plain":
        return -4.0
    if marks != "." or closers:
        return score
    words = text[max(start, at - 60) : at].split()
    if not words or at - len(words[-1]) < start:
        return score
    if before.isspace():
        return score
    raw, last = words[-1], _bare(words[-1])
    prior = words[-2] if len(words) > 1 else ""
    if "(" in raw:
        last = _bare(raw.rsplit("(", 1)[1])
    if last.isdigit() and len(last) <= 2:
        nxt = _WORD.match(text, follow, end)[0].strip(".,;:").lower()
        if opens == "upper" and (_bare(prior) in ORDINAL_BEFORE or nxt in MONTHS):
            return -8.0
        return score
    if len(last) == 1 and last.isalpha():
        if last in ("д", "п") and _bare(prior) in ("т", "и"):
            return {"plain": -5.0}.get(opens, 3.0)
        if last in EITHER and raw.lower() == raw and (prior[:1].isdigit() or prior[-1:].isdigit()):
            return {"plain": -5.0, "name": 2.0}.get(opens, 3.0)
        if not _cased(last) or raw.isupper() or opens in ("plain", "name") or last in NEVER:
            return -8.0
        if opens == "digit":
            return -3.0
        return -8.0 if len(prior) == 2 and prior.endswith(".") else 1.0
    if last in NEVER:
        return -8.0
    if last in EITHER:
        if opens == "plain":
            return -5.0
        if last == "co" and _WORD.match(text, follow, end)[0].strip(".,") in COMPANY_TAIL:
            return -8.0
        if last in ("u.s", "u.k", "e.u") and opens == "upper":
            return 1.0
        return 2.0 if opens == "name" else 3.0
    if re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", last) and opens in ("plain", "name"):
        return -5.0
    return score


def _segments(text: str) -> list[tuple[int, int]]:
    """Stretches between blank lines and before list items at the start of a line."""
    cuts, last = [], 0
    for m in _BLANK_LINE.finditer(text):
        cuts.append((last, m.start()))
        last = m.end()
    cuts.append((last, len(text)))
    out: list[tuple[int, int]] = []
    for a, b in cuts:
        at = a
        for m in _BULLET.finditer(text, a, b):
            line = text[at : m.start()].rstrip()
            if m.start() > a and not line and at == a:
                continue
            if m[1] and line:
                # a number that a wrapped line happens to start with isn't a list number
                end = at + len(line)
                tail = None
                for tail in _PLACE.finditer(text, max(at, end - 4), end):
                    pass
                if tail is None or tail.end() != end:
                    continue
                if tail[0] == "." and (_bare(line.split()[-1]) in NEVER or len(_bare(line.split()[-1])) == 1 and line.split()[-1][0].isupper()):
                    continue
            if m.start() > at:
                out.append((at, m.start()))
                at = m.start()
        out.append((at, b))
    return out


def _n_words(text: str, a: int, b: int, most: int) -> int:
    """Words of a span, counted up to ``most``; a long run without blanks counts as several."""
    n = 0
    for m in _WORD.finditer(text, a, b):
        n += max(1, (m.end() - m.start()) // 8)
        if n >= most:
            break
    return n


def _units(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    if start == end:
        return
    bullet = _ITEM.match(text, start, end)
    first = bullet.end() if bullet and not text[text.rfind("\n", 0, start) + 1 : start].strip() else start
    pairs, opener = _pairs(text, start, end)
    inner = sorted(pairs)
    places: list[tuple[int, int, float, int, bool]] = []  # end, next start, score, opener of a final pair, by its closing mark
    p = 0
    marks: list[tuple[int, re.Match | None, int]] = [(m.start(), m, m.end()) for m in _PLACE.finditer(text, first, end)]
    if any("฀" <= c <= "๿" for c in text[start:end]):
        marks += [(m.start(), None, m.end()) for m in _THAI_BLANK.finditer(text, first, end)]
        marks.sort(key=lambda x: x[0])
    reach = -1
    floor = first
    for at, m, stop in marks:
        if m is None:
            places.append((at, stop, 9.0, -1, False))
            continue
        # a closing mark that in truth opens the next quotation doesn't belong to this end
        cut = m.start()
        while cut < stop and text[cut] in MARKS:
            cut += 1
        k = cut
        final = -1
        while k < stop:
            c = text[k]
            if c.isspace() or c in "\"'" or k in opener and opener[k] < at:
                if k in opener:
                    final = opener[k]
                k += 1
            elif c in "’)]}」』）】" and k not in opener:
                k += 1
            else:
                break
        while k > cut and text[k - 1].isspace():
            k -= 1
        stop = k
        if stop >= end:
            continue
        follow = stop
        while follow < end and text[follow].isspace():
            follow += 1
        while p < len(inner) and inner[p][0] < at:
            reach = max(reach, inner[p][1])
            p += 1
        if reach >= stop:
            continue  # within a quotation or bracket that is closed later
        score = _close_score(text, floor, at, cut, stop, follow, end)
        if score >= FIXED and final < 0:
            floor = follow
        if score > 0 or final >= 0 and score > -8:
            places.append((stop, follow, score, final, text[stop - 1] in ")]}）】"))
    begin, lead = first, start
    while begin < end and text[begin].isspace():
        begin += 1
    run: list[tuple[int, int, float, int, bool]] = []
    for x in [*places, None]:
        if x is not None and (x[2] < FIXED or x[3] >= 0):
            run.append(x)
            continue
        _best_spans(text, lead, begin, x[0] if x else end, run, out)
        run = []
        if x:
            begin = lead = x[1]


def _best_spans(text: str, lead: int, start: int, end: int, places: list[tuple[int, int, float, int, bool]], out: list[tuple[int, int]]) -> None:
    """The best spans of text[start:end] over the open places: best[j] = max over i of best[i] + span(i, j).

    Only the nearest eight words and a leading quotation tell spans with the
    same end apart, so starts further back share one running maximum. ``lead``
    is where the first span begins together with its list number or bullet.
    """
    if not places:
        out.append((lead, end))
        return
    starts = [start, *[x[1] for x in places]]
    ends = [*[x[0] for x in places], end]
    best: list[float] = [0.0]
    back: list[int] = []
    far, far_i, next_far = float("-inf"), 0, 0
    for j, stop in enumerate(ends):
        local, final, bracket = (places[j][2], places[j][3], places[j][4]) if j < len(places) else (0.0, -1, False)
        while next_far <= j and _n_words(text, starts[next_far], stop, 9) > 8 and starts[next_far] != final:
            if best[next_far] > far:
                far, far_i = best[next_far], next_far
            next_far += 1
        top, arg = far + local, far_i
        for i in range(next_far, j + 1):
            s = best[i] + local
            if local and local < FIXED:
                n, dots = _n_words(text, starts[i], stop, 5), text[stop - 1] == "…" or text[stop - 2 : stop] == ".."
                s -= 4.0 if n < 2 else 3.0 if n < 4 and not dots else 0.0
            if final >= 0 and starts[i] == final and not bracket:
                kind = _opens(text, starts[j + 1], end) if j < len(places) and starts[j + 1] < end else "upper"
                s -= 12.0 if kind in ("caseless", "plain", "name") else 3.0
            if bracket and starts[i] == final and local < 0:
                s += 6.0
            if s > top:
                top, arg = s, i
        best.append(top)
        back.append(arg)
    spans, j = [], len(ends) - 1
    while j >= 0:
        i = back[j]
        spans.append((starts[i] if i else lead, ends[j]))
        j = i - 1
    out.extend(reversed(spans))


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentence units of a text, in code points, without white space at either end."""
    out: list[tuple[int, int]] = []
    for a, b in _segments(text):
        _units(text, a, b, out)
    return out


def split_sentences(documents: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(identifier, start_char, end_char) of every sentence unit of every document.

    Null texts and texts of white space only have no units. Documents are cut
    on their own, whole and in place, so no shuffle is needed; repeated rows
    give repeated units. Other columns aren't read.
    """
    kind = dict(documents.dtypes)[identifier]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                spans = [sentence_spans(t) if t else [] for t in part.column(1).to_pylist()]
                at = np.repeat(np.arange(part.num_rows), [len(s) for s in spans])
                flat = np.array([x for s in spans for x in s], dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], ["id", "start_char", "end_char"])

    return documents.select(identifier, text).mapInArrow(work, f"id {kind}, start_char long, end_char long").withColumnRenamed("id", identifier)
