"""Sequential scans over the tokens of one unit, as Arrow UDFs on arrays."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexalign.functions.text import NOTE_REFERENCES
from lexalign.operators.kernels import source_edits
from lexalign.schema import TOKEN

_KIND = T.ArrayType(TOKEN)
_CODE = re.compile(r"\\x\{([0-9a-f]+)\}")
_FORMS = [re.compile(_CODE.sub(lambda m: chr(int(m[1], 16)), form)) for form in NOTE_REFERENCES]
_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]")


def without_notes(tokens: list[dict]) -> list[dict]:
    """Tokens without references to notes, within one or across several: a token goes if a reference covers all of its text,
    with one blank token before it and all behind. Numbers in brackets count as references whatever their length."""
    kept = []
    for x in tokens or ():
        text = x["t"] or ""
        for form in _FORMS:
            text = form.sub("", text)
        if text:
            kept.append({**x, "t": text})
    joined, owner = "".join(x["t"] for x in kept), [i for i, x in enumerate(kept) for _ in x["t"]]
    gone: set[int] = set()
    for form in [*_FORMS, re.compile(r"[\[［〔【(（]\s*[\[［〔【(（]?\s*(?:注|註|訳注|脚注|注釈|注記)?\s*[0-9０-９]+\s*[\]］〕】)）]\s*[\]］〕】)）]?")]:
        for m in form.finditer(joined):
            first, last = owner[m.start()], owner[m.end() - 1]
            whole = (m.start() == 0 or owner[m.start() - 1] != first) and (m.end() == len(joined) or owner[m.end()] != last)
            if not whole or first == last:
                continue
            while last + 1 < len(kept) and not kept[last + 1]["t"].strip():
                last += 1
            if first and not kept[first - 1]["t"].strip():
                first -= 1
            gone |= set(range(first, last + 1))
    return [x for i, x in enumerate(kept) if i not in gone]


@F.udf(_KIND, useArrow=True)
def strip_note_tokens(tokens):
    return None if tokens is None else without_notes([_dict(x) for x in tokens])


def _dict(x) -> dict:
    x = x if isinstance(x, dict) else x.asDict()
    return {k: x.get(k) for k in ("t", "r", "g")}


def resynced(source: str, tokens: list[dict], readings: dict, ahead: int = 5) -> list[dict]:
    """A token for each character of the source; Chinese ones take reading and role from the given tokens, in order, where one
    of the next few has the same character."""
    given = [x for x in tokens if x["t"] and len(x["t"]) == 1 and _HAN.match(x["t"])]
    out, at = [], 0
    for c in source:
        if not _HAN.match(c):
            out.append({"t": c, "r": "", "g": ""})
            continue
        found = next((i for i in range(at, min(at + 1 + ahead, len(given))) if given[i]["t"] == c), None)
        mine = given[found] if found is not None else {}
        at = at if found is None else found + 1
        out.append({"t": c, "r": mine.get("r") or readings.get(c, ""), "g": mine.get("g") or ""})
    return out


@F.udf(_KIND, useArrow=True)
def canonical(source, tokens, readings):
    return resynced(source or "", [_dict(x) for x in tokens or ()], dict(readings or {}))


def repaired(expected: str, tokens: list[dict], most: int = 8) -> list[dict] | None:
    """Tokens changed to join to the expected text, if they differ in a few marks only; else null."""
    got = "".join(x["t"] or "" for x in tokens)
    edits = source_edits(expected, got, most)
    if edits is None:
        return None
    chars = [(c, x, j == 0) for x in tokens for j, c in enumerate(x["t"] or "")]
    for _, a, b, c, d in reversed(edits):
        chars[a:b] = [(e, {"t": e, "r": "", "g": ""}, True) for e in expected[c:d]]
    out: list[dict] = []
    for c, x, begins in chars:
        if out and not begins and out[-1]["_of"] is x:
            out[-1]["t"] += c
        else:
            out.append({**x, "t": c, "_of": x})
    return [{k: x[k] for k in ("t", "r", "g")} for x in out]


@F.udf(_KIND, useArrow=True)
def reconcile(expected, tokens):
    return repaired(expected or "", [_dict(x) for x in tokens or ()])


def two_lines(first: list[dict], second: list[dict], most: int = 54) -> tuple[list[dict], list[dict]]:
    """Tokens moved across the break until both lines hold ``most`` characters at most, if they can."""
    size = lambda line: sum(len("".join((x["t"] or "").split())) for x in line)
    first, second = list(first), list(second)
    if size(first) + size(second) > 2 * most:
        return first, second
    while size(first) > most and size(second) + size(first[-1:]) <= most:
        second.insert(0, first.pop())
    while size(second) > most and size(first) + size(second[:1]) <= most:
        first.append(second.pop(0))
    return first, second


@F.udf(T.ArrayType(_KIND), useArrow=True)
def rebalance_lines(lines):
    if lines is None or len(lines) != 2:
        return None if lines is None else [[_dict(x) for x in line] for line in lines]
    return list(two_lines(*([_dict(x) for x in line] for line in lines)))
