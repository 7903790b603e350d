"""Reading and writing one Avro object container, per the public Avro 1.x specification.

No Avro package is part of a plain Spark installation, and ``from_avro`` reads bare datums
only, so the tasks of ``side_topic`` use this small helper on single payloads.
"""

import functools
import hashlib
import json
import struct
import zlib

MAGIC = b"Obj\x01"


class Symbol(str):
    """An enum symbol, kept apart from text."""


def _varint(buf, pos):
    byte = buf[pos]
    if byte < 0x80:
        return (byte >> 1) ^ -(byte & 1), pos + 1
    shift = value = 0
    while True:
        byte = buf[pos]
        pos += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            if value >> 64:
                raise ValueError("variable-length number has more than 64 bits")
            return (value >> 1) ^ -(value & 1), pos
        shift += 7
        if shift > 63:
            raise ValueError("invalid variable-length number")


def _bytes(buf, pos):
    size, pos = _varint(buf, pos)
    return _fixed(buf, pos, size)


def _fixed(buf, pos, size):
    end = pos + size
    if size < 0 or end > len(buf):
        raise ValueError("truncated payload")
    return buf[pos:end], end


def _text(buf, pos):
    data, pos = _bytes(buf, pos)
    return data.decode("utf-8", "replace"), pos


def _number(layout):
    unpack, size = struct.Struct(layout).unpack, struct.calcsize(layout)

    def read(buf, pos):
        data, pos = _fixed(buf, pos, size)
        return unpack(data)[0], pos

    return read


def _blocks(buf, pos, read_item):
    """Items of an array or a map, which come in counted blocks."""
    items = []
    while True:
        count, pos = _varint(buf, pos)
        if count == 0:
            return items, pos
        if count < 0:
            count, (_, pos) = -count, _varint(buf, pos)
        for _ in range(count):
            item, pos = read_item(buf, pos)
            items.append(item)


PRIMITIVES = {
    "null": lambda buf, pos: (None, pos),
    "boolean": lambda buf, pos: (buf[pos] != 0, pos + 1),
    "int": _varint,
    "long": _varint,
    "float": _number("<f"),
    "double": _number("<d"),
    "bytes": _bytes,
    "string": _text,
}


def _reader(schema, named, space="", wanted=None, text=_text):
    """A function ``(buf, pos) -> (value, pos)`` for a schema.

    ``wanted`` names the fields of the outermost record that are needed; of the others the
    texts are passed over without being decoded.
    """
    if isinstance(schema, list):
        branches = [_reader(branch, named, space, wanted, text) for branch in schema]

        def read_union(buf, pos):
            index, pos = _varint(buf, pos)
            if not 0 <= index < len(branches):
                raise ValueError("invalid union branch")
            return branches[index](buf, pos)

        return read_union

    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return _reader(kind, named, space, wanted, text)
    if kind == "string":
        return text
    if kind in PRIMITIVES:
        return PRIMITIVES[kind]
    if kind == "array":
        item = _reader(schema["items"], named, space, text=text)
        return lambda buf, pos: _blocks(buf, pos, item)
    if kind == "map":
        item = _reader(schema["values"], named, space, text=text)

        def read_entry(buf, pos):
            name, pos = text(buf, pos)
            value, pos = item(buf, pos)
            return (name, value), pos

        return lambda buf, pos: _blocks(buf, pos, read_entry)
    if kind not in ("record", "enum", "fixed"):
        full = kind if "." in kind or not space else f"{space}.{kind}"
        if full not in named and kind not in named:
            raise ValueError(f"unknown Avro type {kind}")
        return lambda buf, pos: (named.get(full) or named[kind])(buf, pos)

    name = schema["name"]
    space = name.rpartition(".")[0] or schema.get("namespace", space)
    full = name if "." in name or not space else f"{space}.{name}"
    if kind == "enum":
        symbols = [Symbol(symbol) for symbol in schema["symbols"]]

        def read(buf, pos):
            index, pos = _varint(buf, pos)
            return symbols[index], pos

    elif kind == "fixed":
        size = schema["size"]

        def read(buf, pos):
            return _fixed(buf, pos, size)

    else:
        fields = []

        def read(buf, pos):
            record = {}
            for field, read_field in fields:
                record[field], pos = read_field(buf, pos)
            return record, pos

    named[full] = read
    if kind == "record":
        for field in schema["fields"]:
            passed = wanted is not None and field["name"] not in wanted
            fields.append((field["name"], _reader(field["type"], named, space, text=_bytes if passed else text)))
    return read


@functools.lru_cache(maxsize=64)
def _compiled(schema_text, wanted):
    return _reader(json.loads(schema_text), {}, wanted=wanted)


#: Parsed headers by their length and bytes, as payloads of one topic mostly share theirs.
_parsed_headers: dict = {}


def _open_container(payload, wanted):
    """Codec, record reader and the end of the header of a payload."""
    for size, known in _parsed_headers.items():
        found = known.get((payload[4:size], wanted))
        if found:
            return *found, size
    meta, pos = _read_meta(payload, 4)
    codec = meta.get("avro.codec", b"null").decode()
    if codec not in ("null", "deflate"):
        raise ValueError(f"unsupported Avro codec {codec}")
    found = codec, _compiled(meta["avro.schema"].decode("utf-8"), wanted)
    if sum(map(len, _parsed_headers.values())) >= 64:
        _parsed_headers.clear()
    _parsed_headers.setdefault(pos, {})[payload[4:pos], wanted] = found
    return *found, pos


def _read_meta(buf, pos):
    def entry(buf, pos):
        name, pos = _text(buf, pos)
        value, pos = _bytes(buf, pos)
        return (name, value), pos

    entries, pos = _blocks(buf, pos, entry)
    return dict(entries), pos


def read_container(payload: bytes, wanted: frozenset | None = None) -> list:
    """The records of a container as dicts. Any defect is a ``ValueError``.

    Of fields that are not ``wanted`` the texts stay undecoded.
    """
    if not payload:
        raise ValueError("payload is empty")
    if payload[:4] != MAGIC:
        raise ValueError("not an Avro object container")
    try:
        codec, read, pos = _open_container(payload, wanted)
        sync, pos = _fixed(payload, pos, 16)
        records = []
        while pos < len(payload):
            count, pos = _varint(payload, pos)
            block, pos = _bytes(payload, pos)
            if codec == "deflate":
                block = zlib.decompress(block, -15)
            at = 0
            for _ in range(count):
                record, at = read(block, at)
                records.append(record)
            mark, pos = _fixed(payload, pos, 16)
            if mark != sync:
                raise ValueError("sync marker mismatch")
    except (IndexError, KeyError, TypeError, AttributeError, RecursionError, UnicodeDecodeError, zlib.error) as error:
        raise ValueError(f"undecodable payload: {type(error).__name__}: {error}") from error
    if not records:
        raise ValueError("payload has zero records")
    return records


# -- writing ---------------------------------------------------------------------------------


def write_long(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def write_text(value) -> bytes:
    data = value.encode("utf-8") if isinstance(value, str) else bytes(value)
    return write_long(len(data)) + data


def write_optional_text(value) -> bytes:
    return write_long(0) if value is None else write_long(1) + write_text(value)


def write_text_map(entries) -> bytes:
    items = list(entries)
    body = b"".join(write_text(name) + write_text(value) for name, value in items)
    return (write_long(len(items)) + body if items else b"") + write_long(0)


@functools.lru_cache(maxsize=16)
def _header(schema_text: str) -> tuple:
    sync = hashlib.md5(schema_text.encode("utf-8")).digest()
    meta = write_text_map([("avro.schema", schema_text), ("avro.codec", "null")])
    return MAGIC + meta + sync, sync


def write_container(schema_text: str, datum: bytes) -> bytes:
    """A container with the one given datum."""
    header, sync = _header(schema_text)
    return header + write_long(1) + write_text(datum) + sync
