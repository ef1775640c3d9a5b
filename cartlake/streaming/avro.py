"""Avro wire records by the schema id in their header, for sessions without the Avro connector.

The connector reads all records with one schema. Here each id has its own, so one stream may hold records of
several versions of the event: fields are matched by name, those that a version lacks are null
and those the event does not have are passed over. Records are decoded in Arrow batches, field by field for all records
of a version at once, so memory is bounded by the batch and only records out of the ordinary are read one by one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cartlake import schemas as S
from cartlake.operators.rejects import BAD_BODY, NO_HEADER, NO_VALUE, chosen

UNKNOWN_SCHEMA = "unknown schema id"
PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")


def fields_of(schema: str | dict) -> list[tuple[str, list[str]]]:
    """(name, branches) of a flat record schema; a field that is no union has one branch."""
    record = json.loads(schema) if isinstance(schema, str) else schema
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("an event schema is a record")
    found = []
    for field in record["fields"]:
        kind = field["type"]
        branches = [k["type"] if isinstance(k, dict) else k for k in (kind if isinstance(kind, list) else [kind])]
        if not set(branches) <= set(PRIMITIVES):
            raise ValueError(f"field {field['name']} is of type {kind}; events are flat records of simple values")
        found.append((field["name"], branches))
    return found


def _decoder(schemas: dict[int, list[tuple[str, list[str]]]], columns: list[str], header: int, reasons: tuple) -> Callable:
    """The batch function. All it needs is inside, so executors need not have this package."""
    no_value, no_header, unknown, bad_body = reasons

    def run(batches: Iterator) -> Iterator:
        import base64
        import struct

        import numpy as np
        import pyarrow as pa

        place = {name: i for i, name in enumerate(columns)}
        plans = {key: [(place.get(name), branches) for name, branches in fields] for key, fields in schemas.items()}

        def number(data: bytes, at: int) -> tuple[int, int]:
            """A zigzag integer and the place after it."""
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                if byte < 128:
                    return (value >> 1) ^ -(value & 1), at
                shift += 7
                if shift > 63:
                    raise ValueError("integer is too long")

        def record(data: bytes, at: int, plan: list) -> list:
            row = [None] * len(columns)
            for to, branches in plan:
                kind = branches[0]
                if len(branches) > 1:
                    branch, at = number(data, at)
                    if not 0 <= branch < len(branches):
                        raise ValueError("no such branch")
                    kind = branches[branch]
                value = None
                if kind in ("string", "bytes"):
                    size, at = number(data, at)
                    if size < 0 or at + size > len(data):
                        raise ValueError("text ends early")
                    value = data[at : at + size].decode("utf-8") if to is not None else None
                    at += size
                elif kind in ("int", "long"):
                    value, at = number(data, at)
                elif kind in ("float", "double"):
                    size = 4 if kind == "float" else 8
                    (value,), at = struct.unpack_from("<f" if size == 4 else "<d", data, at), at + size
                elif kind == "boolean":
                    value, at = ("false", "true")[data[at]], at + 1
                if to is not None and value is not None:
                    row[to] = value if isinstance(value, str) else str(value)
            return row

        def read(data: bytes | None) -> tuple[list | None, str | None]:
            if data is None:
                return None, no_value
            if len(data) < header:
                return None, no_header
            plan = plans.get(int.from_bytes(data[1:header], "big"))
            if plan is None:
                return None, unknown
            try:
                return record(data, header, plan), None
            except (ValueError, IndexError, struct.error):
                return None, bad_body

        def numbers(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Zigzag integers of at most five bytes, the places after them, and which could be read."""
            ok = at < end
            byte = data[np.where(ok, at, 0)]
            value, at, more, shift = (byte & 127).astype(np.int64), at + 1, ok & (byte > 127), 7
            while shift < 35 and more.any():
                i = np.flatnonzero(more)
                short = at[i] >= end[i]
                ok[i[short]] = more[i[short]] = False
                i = i[~short]
                byte = data[at[i]]
                value[i] |= (byte & 127).astype(np.int64) << shift
                at[i] += 1
                more[i] = byte > 127
                shift += 7
            return (value >> 1) ^ -(value & 1), at, ok & ~more

        def places(data, rows, at, end, plan, starts, sizes) -> np.ndarray:
            """Finds the texts of all records of one version; gives the rows to be read one by one."""
            odd = []

            def keep(ok):
                nonlocal rows, at, end
                if not ok.all():
                    odd.append(rows[~ok])
                    rows, at, end = rows[ok], at[ok], end[ok]

            for to, branches in plan:
                branch = np.zeros(len(rows), np.int64)
                if len(branches) > 1 and len(rows):
                    branch, at, ok = numbers(data, at, end)
                    ok &= (branch >= 0) & (branch < len(branches))
                    keep(ok)
                    branch = branch[ok]
                done = np.ones(len(rows), bool)
                for number_of, kind in enumerate(branches):
                    i = np.flatnonzero(branch == number_of)
                    if kind == "null" or not len(i):
                        continue
                    if kind in ("string", "bytes"):
                        size, after, ok = numbers(data, at[i], end[i])
                        ok &= (size >= 0) & (after + size <= end[i])
                        if to is not None:
                            starts[to][rows[i[ok]]], sizes[to][rows[i[ok]]] = after[ok], size[ok]
                        at[i] = after + np.where(ok, size, 0)
                    elif kind in ("int", "long") and to is None:
                        _, at[i], ok = numbers(data, at[i], end[i])
                    else:
                        ok = np.zeros(len(i), bool)
                    done[i] = ok
                keep(done)
            return np.concatenate(odd) if odd else np.empty(0, np.int64)

        def texts(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
            """A text column from places in the batch; a negative size is a null. Bad UTF-8 raises."""
            there = size >= 0
            ends = np.concatenate(([0], np.cumsum(np.where(there, size, 0))))
            place = np.int32 if data.size < 1 << 31 else np.int64
            shift = (start - ends[:-1])[there].astype(place)
            found = data[np.repeat(shift, size[there]) + np.arange(ends[-1], dtype=place)]
            bits = pa.py_buffer(np.packbits(there, bitorder="little"))
            return pa.Array.from_buffers(
                pa.large_binary(), len(size), [bits, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(found)]
            ).cast(pa.large_string()).cast(pa.string())

        for batch in batches:
            values = batch.column(0).cast(pa.large_binary())
            n = len(values)
            missing = np.asarray(values.is_null().to_pylist(), bool)
            bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1] if n else np.zeros(1, np.int64)
            held = values.buffers()[2]
            data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(1, np.uint8)
            start, end = bounds[:-1], bounds[1:]
            rows = np.flatnonzero(~missing & (end - start >= header))
            key = np.zeros(n, np.int64)
            for i in range(1, header):
                key[rows] = key[rows] << 8 | data[start[rows] + i]
            starts = [np.zeros(n, np.int64) for _ in columns]
            sizes = [np.full(n, -1, np.int64) for _ in columns]
            rest = np.ones(n, bool)
            for version, plan in plans.items():
                mine = rows[key[rows] == version]
                rest[mine] = False
                if len(mine):
                    rest[places(data, mine, start[mine] + header, end[mine], plan, starts, sizes)] = True
            one_by_one = np.flatnonzero(rest)
            for size in sizes:
                size[one_by_one] = -1
            try:
                out = [texts(data, s, z) for s, z in zip(starts, sizes)]
            except pa.ArrowInvalid:
                one_by_one = np.arange(n)
                out = [pa.nulls(n, pa.string()) for _ in columns]
            why, text = [None] * n, [None] * n
            if len(one_by_one):
                lists = [column.to_pylist() for column in out]
                for i in one_by_one.tolist():
                    value = values[i].as_py()
                    row, why[i] = read(value)
                    if row is None:
                        text[i] = None if value is None else base64.b64encode(value).decode()
                    else:
                        for column, found in zip(lists, row):
                            column[i] = found
                out = [pa.array(column, pa.string()) for column in lists]
            yield pa.RecordBatch.from_arrays([*out, pa.array(text, pa.string()), pa.array(why, pa.string())], names=[*columns, "text", "why"])

    return run


def decode(records: DataFrame, schemas: Mapping[int, str | dict], on_bad: str = "fail") -> DataFrame:
    """Wire records to event columns, each by the schema of its id; bad records as in `ingest.decode`."""
    from cartlake.streaming.ingest import HEADER_BYTES

    plans = {int(key): fields_of(schema) for key, schema in schemas.items()}
    reasons = (NO_VALUE, NO_HEADER, UNKNOWN_SCHEMA, BAD_BODY)
    columns = ", ".join(f"`{c}` string" for c in (*S.EVENT_COLUMNS, "text", "why"))
    read = records.select("value").mapInArrow(_decoder(plans, list(S.EVENT_COLUMNS), HEADER_BYTES, reasons), columns)
    kind = F.when(F.col("why").isNotNull(), F.lit(S.REJECTED)).otherwise(F.col(S.EVENT_PARTITION))
    rows = read.select(
        *[(kind if c == S.EVENT_PARTITION else F.col(c)).alias(c) for c in S.EVENT_COLUMNS],
        F.col("text").alias(S.REJECT_TEXT),
        F.col("why").alias(S.REJECT_REASON),
    )
    return chosen(rows, on_bad)


def _varint(value: Column) -> Column:
    """A number from 0 to 2^35 - 1 as Avro writes it, lowest seven bits first."""
    every = F.lit(bytearray(range(256)))

    def byte(i: int) -> Column:
        more = F.when(value >= 1 << 7 * (i + 1), 129).otherwise(1)
        return F.substring(every, F.shiftright(value, 7 * i).bitwiseAND(127).cast("int") + more, F.lit(1))

    long = F.concat(byte(0), byte(1), *[F.when(value >= 1 << 7 * i, byte(i)).otherwise(F.lit(bytearray())) for i in (2, 3, 4)])
    return F.when(value < 128, F.substring(every, value.cast("int") + 1, F.lit(1))).otherwise(long)


def _piece(text: Column | None, branches: list[str]) -> Column | None:
    """A field as Avro bytes: a text column, or null (zero, empty) without one; none for what needs Python."""
    def union(kind: str) -> bytes:
        return bytes([2 * branches.index(kind)]) if len(branches) > 1 else b""

    kind = next((b for b in branches if b != "null"), "null")
    null = F.lit(bytearray(union("null"))) if "null" in branches else None
    if text is None and (null is not None or kind in ("string", "bytes", "int", "long")):
        return null if null is not None else F.lit(bytearray(union(kind) + b"\0"))
    if text is None or kind not in ("string", "bytes"):
        return None
    empty = F.lit(bytearray(union(kind) + b"\0"))
    size = F.octet_length(text).cast("bigint") * 2
    told = F.concat(F.lit(bytearray(union(kind))), _varint(size), text.cast("binary"))
    return F.when(text.isNull(), null if null is not None else empty).otherwise(told)


def encode(events: DataFrame, schema: str | dict, schema_id: int) -> DataFrame:
    """Events as Avro wire records under a schema of nullable strings and constants; the inverse of `decode`.

    Fields that the events do not have are written as null, or as zero where null is no branch.
    """
    fields = fields_of(schema)
    columns = [name for name, _ in fields if name in events.columns]
    pieces = [_piece(F.col(name) if name in columns else None, branches) for name, branches in fields]
    if all(p is not None for p in pieces):
        head = F.lit(bytearray(b"\0" + schema_id.to_bytes(4, "big")))
        return events.select(F.concat(head, *pieces).alias("value"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def number(value: int) -> bytes:
            value = (value << 1) ^ (value >> 63)
            out = bytearray()
            while value > 127:
                out.append(value & 127 | 128)
                value >>= 7
            out.append(value)
            return bytes(out)

        head = b"\0" + schema_id.to_bytes(4, "big")
        for batch in batches:
            texts = {name: batch.column(i).to_pylist() for i, name in enumerate(columns)}
            values = []
            for i in range(batch.num_rows):
                parts = [head]
                for name, branches in fields:
                    text = texts[name][i] if name in texts else None
                    kind = "null" if text is None and "null" in branches else next(b for b in branches if b != "null")
                    if len(branches) > 1:
                        parts.append(number(branches.index(kind)))
                    if kind in ("string", "bytes"):
                        data = (text or "").encode()
                        parts += [number(len(data)), data]
                    elif kind in ("int", "long"):
                        parts.append(number(int(text or 0)))
                    elif kind != "null":
                        raise ValueError(f"{kind} is not written")
                values.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])

    return events.select(*columns).mapInArrow(run, "value binary")
