"""The only Python that runs on executors outside ``llm``: sequential steps that windows cannot express, on Arrow groups."""

from __future__ import annotations

import difflib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def greedy(sizes: list[int], budget: int, rule: str = "exceeds") -> list[int]:
    """Number of the pack of each item. ``exceeds``: an item that would pass the budget opens a new pack, and one larger than
    it stands alone. ``reached``: a pack closes behind the item that reaches the budget."""
    out, pack, held, size = [], 0, 0, 0
    for n in sizes:
        if held and (size + n > budget if rule == "exceeds" else size >= budget):
            pack, held, size = pack + 1, 0, 0
        out.append(pack)
        held, size = held + 1, size + n
    return out


def pack_islands(rows: DataFrame, keys: list[str], budget: int, rule: str = "exceeds", extra: list[str] | None = None) -> DataFrame:
    """Adds ``pack`` to (keys, ord, size, extra); each island of keys is packed alone, in order."""
    schema = T.StructType([rows.schema[c] for c in [*keys, "ord", "size", *(extra or [])]] + [T.StructField("pack", T.IntegerType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        return table.append_column("pack", pa.array(greedy(table["size"].to_pylist(), budget, rule), pa.int32()))

    return rows.select(*keys, "ord", "size", *(extra or [])).groupBy(*keys).applyInArrow(run, schema)


def proportional(a: list[int], b: list[int]) -> list[int]:
    """For each of the items of lengths ``b`` the number of the chapter of lengths ``a`` whose share it falls into: an item
    stays in a chapter as long as its middle lies before the chapter's end. Each chapter gets one at least while there are
    any, and the last takes the rest."""
    ends, total = [], 0
    for n in a:
        total += n
        ends.append(total)
    scale, out, at, done = sum(b) / total if total else 0, [], 0, 0.0
    for i, n in enumerate(b):
        left = len(b) - i
        fresh = not out or out[-1] != at
        if not fresh and at < len(a) - 1 and (done + n / 2 > ends[at] * scale or left <= len(a) - 1 - at):
            at += 1
        out.append(at)
        done += n
    return out


def align_proportionally(rows: DataFrame) -> DataFrame:
    """(book, ord, chapter) for (book, side, ord, size): blocks of side ``b`` dealt to the chapters of side ``a``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        side = table["side"].to_pylist()
        sizes, order = table["size"].to_pylist(), table["ord"].to_pylist()
        a = [n for s, n in zip(side, sizes, strict=True) if s == "a"]
        b = [(o, n) for s, o, n in zip(side, order, sizes, strict=True) if s == "b"]
        book = table["book"][0].as_py()
        got = proportional(a, [n for _, n in b]) if a and b else []
        return pa.table({"book": pa.array([book] * len(got), table["book"].type), "ord": pa.array([o for (o, _), _ in zip(b, got, strict=False)], pa.int32()), "chapter": pa.array(got, pa.int32())})

    book = rows.schema["book"].dataType.simpleString()
    return rows.select("book", "side", F.col("ord").cast("int").alias("ord"), F.col("size").cast("long").alias("size")).groupBy("book").applyInArrow(run, f"book {book}, ord int, chapter int")


def match_in_order(units: list[tuple[str, str]], reference: str, finder, back: int = 8, slack: int = 420) -> list[tuple[int, str]]:
    """Place of each text in a reference, searched from a little before the furthest place so far, then in all of it. A place
    more than ``slack`` behind counts as backward and doesn't move the furthest one."""
    furthest, out = -1, []
    for text, _ in units:
        at = finder(reference, text, max(0, furthest - back))
        if at < 0 <= furthest:
            whole = finder(reference, text, 0)
            at = whole if whole >= 0 and whole + slack >= furthest else -1
        if at < 0:
            out.append((-1, "missing"))
        elif at + slack < furthest:
            out.append((at, "backward"))
        else:
            furthest = max(furthest, at)
            out.append((at, "ok"))
    return out


_HAN = "㐀-䶿一-鿿豈-﫿"
_SKELETON = re.compile(f"[{_HAN}ァ-ヿA-Za-z0-9]")


def find_reference(reference: str, text: str, least: int) -> int:
    """Place of ``text``: literally, then with kana allowed around Chinese characters, then by skeletons of four or more."""
    at = reference.find(text, least)
    if at >= 0 or not text:
        return at
    if re.search(f"[{_HAN}]", text):
        kana = "[ぁ-ゟァ-ヿ]*"
        loose = "".join(f"{kana}{c}{kana}" if re.match(f"[{_HAN}]", c) else re.escape(c) for c in text)
        if found := re.compile(loose).search(reference, least):
            return found.start()
    wanted = "".join(_SKELETON.findall(text))
    if len(wanted) < 4:
        return -1
    places = [i for i, c in enumerate(reference) if i >= least and _SKELETON.match(c)]
    at = "".join(reference[i] for i in places).find(wanted)
    return places[at] if at >= 0 else -1


def match_references(units: DataFrame) -> DataFrame:
    """(chunk_id, ord, position, verdict) for (chunk_id, ord, text, reference), in order within each chunk."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        got = match_in_order([(t, "") for t in table["text"].to_pylist()], table["reference"][0].as_py() or "", find_reference)
        return pa.table({"chunk_id": table["chunk_id"], "ord": table["ord"], "position": pa.array([p for p, _ in got], pa.int32()), "verdict": pa.array([v for _, v in got])})

    kind = units.schema["chunk_id"].dataType.simpleString()
    return units.select("chunk_id", F.col("ord").cast("int").alias("ord"), "text", "reference").groupBy("chunk_id").applyInArrow(run, f"chunk_id {kind}, ord int, position int, verdict string")


def source_edits(expected: str, got: str, most: int, content: str = f"[{_HAN}A-Za-z0-9ぁ-ゟ゠-ヿ]") -> list[tuple[str, int, int, int, int]] | None:
    """Edits that turn ``got`` into ``expected``, if all are short and touch no content."""
    edits = [e for e in difflib.SequenceMatcher(None, got, expected, autojunk=False).get_opcodes() if e[0] != "equal"]
    for _, a, b, c, d in edits:
        if max(b - a, d - c) > most or re.search(content, got[a:b] + expected[c:d]):
            return None
    return edits


def balanced_json(text: str) -> str | None:
    """The first JSON object in free text; braces inside strings don't count."""
    begin = text.find("{")
    if begin < 0:
        return None
    depth, quoted, escaped = 0, False, False
    for i in range(begin, len(text)):
        c = text[i]
        if quoted:
            quoted, escaped = (not (c == '"' and not escaped)), c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[begin : i + 1]
    return None


def parsed_object(text: str | None) -> str | None:
    """Canonical JSON of the object in an answer, with stray and doubled commas repaired; null if there is none."""
    found = balanced_json(text or "")
    for attempt in (found, re.sub(r",\s*,", ",", re.sub(r",(\s*[}\]])", r"\1", found)) if found else None):
        if attempt is not None:
            try:
                return json.dumps(json.loads(attempt), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            except ValueError:
                continue
    return None


@F.udf(T.StringType(), useArrow=True)
def extract_json(text):
    return parsed_object(text)
