"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

Patterns find e-mail addresses, IP addresses, card and phone numbers of fixed forms. The field adds numbers and addresses
whose shape and neighbours look like those: it is trained here, from a small labelled table made by rule, and decoded by
Viterbi in numpy over many runs of words at once. A word without a digit or @ can only be outside, so whole texts fall apart
into runs of words that have one, without a change of the best path. What the field finds never replaces or touches what a
pattern found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import bounded_batches
from lexalign.llm.words import BLANKS, chunks

KINDS = ("email", "ip", "card", "phone")
#: States: outside, then a word that begins a span of each kind, then one that goes on.
STATES = 1 + 2 * len(KINDS)
EXAMPLES, ROUNDS, RATE, PENALTY, SEED = 1000, 150, 0.1, 1e-3, 5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits either matches from its first one or not at all
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in time that grows with the text: only an @ can
    make one, and the leftmost begins where the run of characters before it does."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at)):
            yield begin, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all matches of the fixed forms, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) < 4 and int(p or "0") < 256 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# Word shapes


def _strip(word: str) -> tuple[int, int]:
    """Where a word begins and ends without the marks around it."""
    a, b = 0, len(word)
    while a < b and word[a] in "\"'<[{,;:|":
        a += 1
    while b > a and word[b - 1] in "\"'>]},;:|.!?":
        b -= 1
    return a, b


_FEATURES = ("bias", "digits1-2", "digits3", "digits4", "digits5-9", "digits10-13", "digits14-19", "digits20+", "letters", "at", "at_dot", "plus", "parens", "hyphens1", "hyphens2+", "dots1", "dots2", "dots3", "dots4+", "slash", "equals", "colon", "underscore", "luhn", "octets", "all_digits", "digit_groups", "starts_letter", "money", "hex")
_NEIGHBOURS = ("none", "plain", "digits1-2", "digits3", "digits4", "digits5+", "parens", "mixed", "cue_phone", "cue_card", "cue_ip", "cue_email")
_CUES = {"phone": 8, "tel": 8, "call": 8, "mobile": 8, "fax": 8, "tel.": 8, "phone:": 8, "tel:": 8, "call:": 8, "card": 9, "card:": 9, "visa": 9, "ip": 10, "host": 10, "ip:": 10, "server": 10, "mail": 11, "email": 11, "e-mail": 11, "mail:": 11, "email:": 11}
N_FEATURES = len(_FEATURES) + 2 * len(_NEIGHBOURS)


def _neighbour(word: str | None) -> int:
    if word is None:
        return 0
    if word.lower() in _CUES:
        return _CUES[word.lower()]
    n = sum(c.isdigit() for c in word)
    if not n:
        return 1
    if "(" in word:
        return 6
    if n < len(word.strip(".,;:")):
        return 7
    return 2 if n < 3 else n if n < 5 else 5


def shape(word: str, before: str | None, after: str | None) -> list[int]:
    """Numbers of the features that hold."""
    a, b = _strip(word)
    w = word[a:b]
    digits = "".join(c for c in w if "0" <= c <= "9")
    n = len(digits)
    letters = sum(c.isalpha() for c in w)
    hyphens, dots = w.count("-"), w.count(".")
    parts = w.split(".")
    hold = {
        "bias": True, "digits1-2": 1 <= n <= 2, "digits3": n == 3, "digits4": n == 4, "digits5-9": 5 <= n <= 9, "digits10-13": 10 <= n <= 13, "digits14-19": 14 <= n <= 19, "digits20+": n > 19,
        "letters": letters > 0, "at": "@" in w, "at_dot": "@" in w and "." in w.rpartition("@")[2], "plus": w.startswith("+"), "parens": "(" in w and ")" in w, "hyphens1": hyphens == 1, "hyphens2+": hyphens > 1,
        "dots1": dots == 1, "dots2": dots == 2, "dots3": dots == 3, "dots4+": dots > 3, "slash": "/" in w, "equals": "=" in w, "colon": ":" in w, "underscore": "_" in w,
        "luhn": 14 <= n <= 19 and luhn(digits), "octets": len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts), "all_digits": n > 0 and n == len(w), "digit_groups": hyphens > 0 and all(p.isdigit() for p in w.replace("(", "").replace(")", "").split("-")),
        "starts_letter": w[:1].isalpha(), "money": any(c in w for c in "$€£%"), "hex": n > 0 and letters > 0 and len(w) > 15,
    }
    base = len(_FEATURES)
    return [i for i, name in enumerate(_FEATURES) if hold[name]] + [base + _neighbour(before), base + len(_NEIGHBOURS) + _neighbour(after)]


# The labelled table


def _card(rng: np.random.Generator, good: bool) -> str:
    head = "".join(map(str, rng.integers(0, 10, 15)))
    check = next(c for c in "0123456789" if luhn(head + c))
    return head + (check if good else str((int(check) + int(rng.integers(1, 10))) % 10))


def examples(count: int = EXAMPLES, seed: int = SEED) -> list[tuple[list[str], list[int]]]:
    """Labelled word sequences: prose with numbers of all sorts, and personal data in forms that the patterns know or not."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("aeioutnrshldm"), int(rng.integers(2, 9))))
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    host = lambda: f"{word()}.{rng.choice(['com', 'org', 'net', 'de'])}"
    octets = lambda: ".".join(str(rng.integers(0, 256)) for _ in range(4))
    personal = [
        lambda: (1, f"{word()}.{word()}@{host()}"), lambda: (1, f"{word()}{number(2)}@{word()}.{host()}"), lambda: (1, f"<{word()}@{host()}>,"), lambda: (1, f"{word()}_{word()}@{host()}."),
        lambda: (2, octets()), lambda: (2, octets() + ","), lambda: (2, f"[{octets()}]"),
        lambda: (3, _card(rng, True)), lambda: (3, "{} {} {} {}".format(*(lambda c: (c[:4], c[4:8], c[8:12], c[12:]))(_card(rng, True)))), lambda: (3, "-".join((lambda c: (c[:4], c[4:8], c[8:12], c[12:]))(_card(rng, True)))),
        lambda: (4, f"+{rng.integers(1, 99)} ({number(3)}) {number(3)}-{number(4)}"), lambda: (4, f"({number(3)}) {number(3)}-{number(4)}"), lambda: (4, f"{number(3)}-{number(3)}-{number(4)}"), lambda: (4, f"+{rng.integers(1, 99)} {number(3)} {number(3)} {number(4)}"), lambda: (4, f"+{number(11)}"), lambda: (4, f"({number(3)}) {number(3)}-{number(4)}."),
    ]
    other = [
        lambda: str(rng.integers(1000, 2100)), lambda: number(int(rng.integers(1, 4))), lambda: f"{number(2)}:{number(2)}", lambda: f"{number(4)}-{number(2)}-{number(2)}", lambda: f"${number(3)}.{number(2)}", lambda: f"v{rng.integers(0, 9)}.{rng.integers(0, 99)}.{rng.integers(0, 9)}",
        lambda: "".join(rng.choice(list("0123456789abcdef"), 40)), lambda: "\"" + "".join(rng.choice(list("0123456789abcdef"), 40)) + "\"", lambda: _card(rng, False), lambda: number(int(rng.integers(5, 14))), lambda: f"{number(2)}%", lambda: f"{word()}{number(2)}", lambda: f"{number(3)}/{number(4)}",
        lambda: f"{rng.integers(300, 999)}.{number(3)}.{number(3)}.{number(3)}", lambda: f"{number(3)}-{number(4)}", lambda: f"{number(1)}.{number(2)}", lambda: f"@{word()}", lambda: f"{word()}@", lambda: f"http://{host()}/{number(4)}", lambda: f"{number(4)},", lambda: f"({number(4)})", lambda: f"{number(3)},{number(3)}", lambda: f"{word()}-{number(3)}", lambda: number(int(rng.integers(20, 40))),
    ]
    out = []
    for _ in range(count):
        words, states = [], []
        for _ in range(int(rng.integers(2, 6))):
            plain = [word() for _ in range(int(rng.integers(1, 5)))]
            words += plain
            states += [0] * len(plain)
            if rng.random() < 0.4:
                kind, text = personal[int(rng.integers(len(personal)))]()
                parts = text.split(" ")
                words += parts
                states += [2 * kind - 1] + [2 * kind] * (len(parts) - 1)
            else:
                words.append(other[int(rng.integers(len(other)))]())
                states.append(0)
        out.append((words, states))
    return out


def has_sign(word: str) -> bool:
    return "@" in word or any("0" <= c <= "9" for c in word)


def runs(words: list[str]) -> list[tuple[int, int]]:
    """Longest runs of words with a digit or @."""
    out, begin = [], None
    for i, w in enumerate([*words, ""]):
        if has_sign(w):
            begin = i if begin is None else begin
        elif begin is not None:
            out.append((begin, i))
            begin = None
    return out


#: A state that goes on must follow one of its kind; a run ends and begins outside.
ALLOWED = np.ones((STATES, STATES), bool)
for _k in range(1, len(KINDS) + 1):
    ALLOWED[:, 2 * _k] = False
    ALLOWED[[2 * _k - 1, 2 * _k], 2 * _k] = True
FORBIDDEN = -1e6


class Field:
    """Weights of the features by state, and of the steps between states."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    def steps(self) -> np.ndarray:
        return np.where(ALLOWED, self.step, FORBIDDEN)

    def viterbi(self, sequences: list[list[list[int]]]) -> list[list[int]]:
        """The best states of each sequence of features. Outside surrounds it."""
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        step = self.steps()
        begin = 0
        while begin < len(order):  # sequences of like lengths together, some 64,000 places at most (or one sequence)
            end = begin + 1
            while end < len(order) and len(sequences[order[end]]) * (end + 1 - begin) <= 65_536:
                end += 1
            mine = order[begin:end]
            sizes = np.array([len(sequences[i]) for i in mine])
            longest = int(sizes.max())
            score = np.zeros((len(mine), longest, STATES))
            for row, i in enumerate(mine):
                for t, hold in enumerate(sequences[i]):
                    score[row, t] = self.emit[hold].sum(axis=0)
            best = score[:, 0] + step[0]
            back = np.zeros((longest, len(mine), STATES), np.int8)
            for t in range(1, longest):
                every = best[:, :, None] + step[None]
                back[t] = every.argmax(axis=1)
                there = every.max(axis=1) + score[:, t]
                best = np.where((t < sizes)[:, None], there, best)
            state = (best + step[:, 0]).argmax(axis=1)
            paths = np.zeros((len(mine), longest), np.int8)
            for t in range(longest - 1, -1, -1):
                paths[:, t] = state
                inside = t < sizes
                state = np.where(inside, back[t, np.arange(len(mine)), state], state) if t else state
                if t:
                    state = np.where(t < sizes, state, paths[:, t])
            for row, i in enumerate(mine):
                out[i] = paths[row, : sizes[row]].tolist()
            begin = end
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@lru_cache(maxsize=1)
def trained() -> Field:
    """The field of the module's own examples."""
    return fit()


def fit(rows: list[tuple[list[str], list[int]]] | None = None, rounds: int = ROUNDS, rate: float = RATE, penalty: float = PENALTY) -> Field:
    """Maximum likelihood of the labelled runs, with a penalty on the squared weights, by Adam. The same on every machine."""
    runs_: list[tuple[list[list[int]], list[int]]] = []
    for words, labels in rows or examples():
        for a, b in runs(words):
            runs_.append(([shape(words[i], words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None) for i in range(a, b)], labels[a:b]))
    runs_.sort(key=lambda r: -len(r[0]))  # the runs that reach place t are then the first `live[t]`
    sizes = np.array([len(r[0]) for r in runs_])
    n, longest = len(runs_), int(sizes.max())
    live = [int((sizes > t).sum()) for t in range(longest)]
    x = [np.zeros((k, N_FEATURES)) for k in live]
    truth = [np.array([r[1][t] for r in runs_[:k]]) for t, k in enumerate(live)]
    for t, k in enumerate(live):
        for i in range(k):
            x[t][i, runs_[i][0][t]] = 1
    emit_seen = sum(a.T @ np.eye(STATES)[b] for a, b in zip(x, truth, strict=True))
    step_seen = np.zeros((STATES, STATES))
    for _, s in runs_:
        for a, b in zip([0, *s], [*s, 0], strict=True):
            step_seen[a, b] += 1
    emit, step = np.zeros((N_FEATURES, STATES)), np.zeros((STATES, STATES))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    for turn in range(1, rounds + 1):
        moves = np.where(ALLOWED, step, FORBIDDEN)
        score = [a @ emit for a in x]
        ahead = [score[0] + moves[0]]
        for t in range(1, longest):
            ahead.append(_log_sum(ahead[-1][: live[t], :, None] + moves[None], 1) + score[t])
        last = np.empty((n, STATES))
        for t, k in enumerate(live):
            last[:k] = ahead[t]
        total = _log_sum(last + moves[:, 0], 1)
        behind = [np.empty(0)] * longest
        for t in range(longest - 1, -1, -1):
            behind[t] = np.tile(moves[:, 0], (live[t], 1))
            if t + 1 < longest:
                k = live[t + 1]
                behind[t][:k] = _log_sum(moves[None] + (score[t + 1] + behind[t + 1])[:, None, :], 2)
        share = [np.exp(a + b - total[: len(a), None]) for a, b in zip(ahead, behind, strict=True)]
        emit_hoped = sum(a.T @ b for a, b in zip(x, share, strict=True))
        step_hoped = np.zeros((STATES, STATES))
        step_hoped[0] += share[0].sum(axis=0)
        for t, k in enumerate(live):
            ends = live[t + 1] if t + 1 < longest else 0
            step_hoped[:, 0] += share[t][ends:k].sum(axis=0)
            if t:
                step_hoped += np.exp(ahead[t - 1][:k, :, None] + moves[None] + (score[t] + behind[t])[:, None, :] - total[:k, None, None]).sum(axis=0)
        for i, (weights, slope) in enumerate(((emit, (emit_seen - emit_hoped) / n - penalty * emit), (step, (step_seen - step_hoped) / n - penalty * step))):
            first, second = moments[2 * i], moments[2 * i + 1]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            weights += rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return Field(emit, step)


# Whole texts

_SIGNS = np.zeros(256, bool)
_SIGNS[[0x40, *range(0x30, 0x3A)]] = True


_FORMS = [re.compile(p) for p in (r"[^\s@]+@[^\s@]+", r"[0-9]+(\.[0-9]+){3}", r"[0-9][0-9\x20-]*[0-9]", r"[+(]?[0-9][\x20().0-9-]*[0-9]")]


def _plausible(kind: int, text: str) -> bool:
    """What a span of a kind must have, whatever the field says."""
    digits = _NOT_DIGIT.sub("", text)
    return bool(_FORMS[kind].fullmatch(text)) and (True, True, 14 <= len(digits) <= 19 and luhn(digits), 7 <= len(digits) <= 15)[kind]


def marked_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words between blanks: start and end in bytes, document, and whether there is a digit or @."""
    inside = ~BLANKS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    padded = np.zeros(len(data) + 2, bool)
    padded[1:-1] = inside
    start = np.flatnonzero(padded[1:] & (~padded[:-1] | edge))
    end = np.flatnonzero(padded[:-1] & (~padded[1:] | edge))
    signs = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SIGNS[data], out=signs[1:])
    return start, end, np.searchsorted(offsets, start, "right") - 1, signs[end] > signs[start]


def added(field: Field, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text the field's spans (start, kind, end) in code points, in order."""
    start, end, doc, signed = marked_words(data, offsets)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    where = np.flatnonzero(signed)
    if not len(where):
        return out
    raw = data.tobytes()
    point = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=point[1:])
    word = lambda i: raw[start[i] : end[i]].decode(errors="replace")
    near = lambda i, j: word(j) if 0 <= j < len(doc) and doc[j] == doc[i] else None
    cuts = np.flatnonzero((np.diff(where) > 1) | (np.diff(doc[where]) > 0)) + 1
    groups = np.split(where, cuts)
    words = {int(i): word(i) for i in where}
    paths = field.viterbi([[shape(words[int(i)], near(i, i - 1), near(i, i + 1)) for i in g] for g in groups])
    for g, path in zip(groups, paths, strict=True):
        t = 0
        while t < len(path):
            if not path[t]:
                t += 1
                continue
            kind, last = (path[t] + 1) // 2, t
            while last + 1 < len(path) and path[last + 1] == 2 * kind:
                last += 1
            a, b = g[t], g[last]
            d = int(doc[a])
            skip, last_word = _strip(words[int(a)])[0], words[int(b)]
            over = len(last_word) - _strip(last_word)[1]  # the marks around a word have one byte each
            begin = int(point[start[a]] - point[offsets[d]]) + skip
            stop = int(point[end[b]] - point[offsets[d]]) - over
            text = raw[start[a] + skip : end[b] - over].decode(errors="replace") if stop > begin else ""
            if text and _plausible(kind - 1, text):
                out[d].append((begin, kind - 1, stop))
            t = last + 1
    return out


def apart(more: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``more`` that touch none of ``base``; both in order of their starts."""
    out, at, reach = [], 0, 0
    for s in sorted(more, key=lambda s: s[2]):
        while at < len(base) and base[at][0] < s[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= s[0]:
            out.append(s)
    return out


def spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[str, list, list]]:
    """For each text: the text, the patterns' spans, and all spans."""
    more = added(field, data, offsets)
    signs = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SIGNS[data], out=signs[1:])
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        text = data[a:b].tobytes().decode(errors="replace")
        base = patterns(text) if signs[b] > signs[a] else []
        extra = apart(more[i], base)
        yield text, base, sorted(base + extra)


def listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _find(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                rows = [([sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))], hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)) for _, base, every in spans(field, data, offsets)]
                counts = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def _mask(field: Field, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, column):
                out = []
                for text, _, every in spans(field, data, offsets):
                    pieces, at = [], 0
                    for a, k, b in every:
                        if a >= at:
                            pieces += [text[at:a], f"<{KINDS[k].upper()}>"]
                        at = max(at, b)
                    out.append("".join([*pieces, text[at:]]))
                valid = part.column(column).is_valid().to_pylist()
                new = pa.array([x if ok else None for x, ok in zip(out, valid, strict=True)], pa.large_string())
                yield pa.RecordBatch.from_arrays([new if n == column else part.column(n) for n in part.schema.names], names=part.schema.names)

    return run


def find_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): a row for each row of ``docs``.

    The counts and the digest are of the patterns' spans; ``spans`` lists these and the field's as kind:start:end in code
    points, the end exclusive, by start and then kind. A null text counts as empty and has no spans. Repeated rows get equal
    results. Other columns are ignored. An empty table gives an empty result.
    """
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find(trained()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask_pii(spark: SparkSession, docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with each span of ``column`` replaced by its kind, as in ``<EMAIL>``; where spans overlap, the first one's. A
    null text stays null. All columns stay."""
    bounded_batches(spark)
    return docs.mapInArrow(_mask(trained(), column), docs.schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
