"""Deeply nested records as related flat tables, by one depth-first pass that tags every row with its table."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import Decimal, localcontext

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows

TAGGED = "record_id bigint, elem string, parent string, pos int, val string"
#: The tables that the tagged rows separate into, with the names that parent and val get there.
TABLES = {"width": ("lane", "s_offset_mm"), "road_mark": ("lane", "s_offset_mm"), "connection": ("junction", "connecting_road"), "lane_link": ("connection", "from_to"), "member": ("relation", "role")}
SIDES = ("left", "center", "right")
_NUMBER = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
#: Decimal exponents beyond this are no finite numbers, as in a double.
_EXPONENT = 308


def _items(x: object) -> list:
    """An array, or an element that stands alone, as a list; absent and null as none."""
    return x if isinstance(x, list) else [] if x is None else [x]


def _attr(x: dict, name: str) -> str:
    """An attribute's text as it stands, without surrounding blanks; its name may carry a one-character prefix.

    Empty if absent, null or no plain value. A name without prefix comes first.
    """
    value = x.get(name)
    if value is None:
        value = next((v for k, v in x.items() if len(k) == len(name) + 1 and k.endswith(name) and v is not None and not isinstance(v, (dict, list))), None)
    if value is None or isinstance(value, (dict, list)):
        return ""
    text = ("true" if value else "false") if isinstance(value, bool) else str(value).strip()
    return text if text.isascii() else text.encode("utf-8", "replace").decode()  # half a surrogate pair is no text


def _millimetres(text: str) -> str:
    """Metres as whole millimetres, exactly, halves to even; empty if it is no decimal number or too great for a double."""
    match = _NUMBER.fullmatch(text)
    if not match:
        return ""
    digits, exponent = match[1], int((match[2] or "e0")[1:])
    head = digits.partition(".")[0].lstrip("0")
    tail = digits.partition(".")[2]
    first = len(head) if head else len(tail.lstrip("0")) - len(tail)  # the place of the first digit before the point
    if not (head + tail).strip("0"):
        return "0"
    if first + exponent > _EXPONENT + 1:
        return ""
    if first + exponent < -4:
        return "0"
    with localcontext(prec=len(digits) + _EXPONENT + 10, Emax=10**9, Emin=-(10**9)):
        metres = Decimal(("-" if text.startswith("-") else "") + digits).scaleb(exponent)
        if abs(metres) > _GREATEST:
            return ""
        return str(int(metres.scaleb(3).to_integral_value()))


_GREATEST = Decimal(1.7976931348623157e308)


def _named(tree: object, kind: str) -> Iterator[dict]:
    """The outermost elements of that name, through outer objects and arrays of any depth, in the order of the text."""
    open_ = [tree]
    while open_:
        x = open_.pop()
        if isinstance(x, list):
            open_.extend(reversed(x))
        elif isinstance(x, dict):
            yield from (e for e in _items(x.get(kind)) if isinstance(e, dict))
            open_.extend(v for k, v in reversed(x.items()) if k != kind and isinstance(v, (dict, list)))


_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')
_WORDS = {"true": True, "false": False, "null": None}


def parse_deep(text: str) -> object:
    """JSON of any depth, with an explicit stack; numbers stay text. ``ValueError`` where it is not valid.

    Only for texts that the built-in parser gives up on because they nest too deeply.
    """
    stack: list[tuple[object, object]] = []  # (container, key that the next value goes under)
    at, box, key, want = 0, [], None, "value"
    top = box
    while True:
        match = _TOKEN.match(text, at)
        if not match:
            if want == "end" and not text[at:].strip(" \t\n\r"):
                return top[0]
            raise ValueError(f"no JSON at {at}")
        at = match.end()
        mark, quoted, number, word = match.groups()
        if want in ("value", "value or close") and mark != "]" and mark not in (",", ":", "}"):
            if mark:
                new: object = {} if mark == "{" else []
            else:
                new = json.loads(quoted) if quoted else number if number else _WORDS[word]
            if isinstance(box, dict):
                box[key] = new
            else:
                box.append(new)
            if mark:
                stack.append((box, key))
                box, want = new, "key or close" if mark == "{" else "value or close"
            else:
                want = "next" if stack else "end"
        elif want in ("key", "key or close") and quoted:
            key, want = json.loads(quoted), "colon"
        elif want == "colon" and mark == ":":
            want = "value"
        elif want == "next" and mark == ",":
            want = "key" if isinstance(box, dict) else "value"
        elif want in ("next", "key or close", "value or close") and mark == ("}" if isinstance(box, dict) else "]"):
            box, key = stack.pop()
            want = "next" if stack else "end"
        else:
            raise ValueError(f"no JSON at {at}")


def _road(road: dict) -> Iterator[tuple[str, str, int, str]]:
    lanes = road.get("lanes")
    if not isinstance(lanes, dict):
        return
    for section_pos, section in enumerate(_items(lanes.get("laneSection"))):
        for side in SIDES if isinstance(section, dict) else ():
            group = section.get(side)
            for lane in _items(group.get("lane")) if isinstance(group, dict) else ():
                if isinstance(lane, dict):
                    parent = f"{_attr(road, 'id')}/{section_pos}/{side}/{_attr(lane, 'id')}"
                    for child, elem in (("width", "width"), ("roadMark", "road_mark")):
                        for pos, x in enumerate(_items(lane.get(child))):
                            if isinstance(x, dict):
                                yield elem, parent, pos, _millimetres(_attr(x, "sOffset"))


def _junction(junction: dict) -> Iterator[tuple[str, str, int, str]]:
    own = _attr(junction, "id")
    for pos, connection in enumerate(_items(junction.get("connection"))):
        if isinstance(connection, dict):
            yield "connection", own, pos, _attr(connection, "connectingRoad")
            for k, link in enumerate(_items(connection.get("laneLink"))):
                if isinstance(link, dict):
                    yield "lane_link", f"{own}/{pos}", k, f"{_attr(link, 'from')}:{_attr(link, 'to')}"


def _relation(relation: dict) -> Iterator[tuple[str, str, int, str]]:
    for pos, member in enumerate(_items(relation.get("member"))):
        if isinstance(member, dict):
            yield "member", _attr(relation, "id"), pos, _attr(member, "role")


_VISITORS = {"road": _road, "junction": _junction, "relation": _relation}


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not valid JSON")


def parse(payload: str) -> object:
    """The JSON text as objects and arrays, its numbers as they stand; ``ValueError`` where it is not valid."""
    try:
        return json.loads(payload, parse_float=str, parse_int=str, parse_constant=_no_constant)
    except RecursionError:
        return parse_deep(payload)


def visit(kind: str | None, payload: str | None) -> Iterator[tuple[str, str, int, str]]:
    """(table tag, parent key, position, value) of one record, depth first; nothing if it is not usable."""
    visitor = _VISITORS.get(kind or "")
    if visitor is None or not payload:
        return
    try:
        tree = parse(payload)
    except ValueError:
        return
    for element in _named(tree, kind):
        yield from visitor(element)


def fault(kind: str | None, payload: str | None) -> str | None:
    """Why a record gives no rows: ``kind``, ``empty``, ``not json`` or ``no element``; none where it is usable."""
    if (kind or "") not in _VISITORS:
        return "kind"
    if not payload:
        return "empty"
    try:
        return None if any(True for _ in _named(parse(payload), kind)) else "no element"
    except ValueError:
        return "not json"


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
    names = ["record_id", "elem", "parent", "pos", "val"]
    for batch in batches:
        rows: list[tuple] = []
        for record, kind, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows.extend((record, *row) for row in dict.fromkeys(visit(kind, payload)))
            if len(rows) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def flatten_records(records: DataFrame) -> DataFrame:
    """Tagged flat rows (record_id, elem, parent, pos, val) of all elements of nested records.

    ``records`` has record_id, kind and payload (JSON text). Every payload is parsed once and all tables come from that
    one pass; rows stay in the partition they were read in, so nothing is shuffled. Null or unknown kinds, null, empty
    and invalid payloads, and payloads without the element named by kind give no row; an element that is no object is
    passed over but counts as a place. Other columns are ignored. A record gives no row twice, as it could where two of
    its elements have one id; repeated records are the caller's (see ``current_records``).
    """
    return records.select("record_id", "kind", "payload").mapInArrow(_emit, TAGGED)


def unusable_records(records: DataFrame) -> DataFrame:
    """(record_id, fault) of the records that ``flatten_records`` passes over, so that none is lost unseen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r, why) for r, kind, payload in zip(*(batch.column(i).to_pylist() for i in range(3))) if (why := fault(kind, payload))]
            ids, why = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(why, pa.string())], ["record_id", "fault"])

    return records.select("record_id", "kind", "payload").mapInArrow(run, "record_id bigint, fault string")


def write_tables(tagged: DataFrame, path: str) -> None:
    """Writes the tagged rows partitioned by tag."""
    tagged.write.mode("overwrite").partitionBy("elem").parquet(path)


def table_of(tagged: DataFrame, elem: str) -> DataFrame:
    """The table of one tag with its own column names; on a written folder only that partition is read."""
    parent, value = TABLES[elem]
    cols = [F.col("record_id"), F.col("parent").alias(f"{parent}_key"), F.col("pos"), F.concat_ws("/", "parent", "pos").alias(f"{elem}_key")]
    val = F.when(F.col("val") != "", F.col("val").try_cast("bigint")) if value == "s_offset_mm" else F.col("val")
    return tagged.where(F.col("elem") == elem).select(*cols, val.alias(value))


def current_records(raw_map_record: DataFrame) -> DataFrame:
    return current_rows(raw_map_record.select("record_id", "loaded_at", "kind", "payload"), ["record_id"])
