"""What a PLY file is made of: header, element layout, vertex bodies in text and binary.

Pure helpers over bytes and Arrow batches; nothing here knows about Spark.  A file is a text header,
then its elements in the order of the header.  Bodies are ASCII lines, or records in either byte
order.  Vertices are read wherever they stand, as long as what stands before them has a fixed size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from drapekit.functions.coords import CloudError

# fixed values: header keywords, type names with their numpy and Spark types, and what an
# exported column's Spark type is called
HEADER_KEYWORDS = ("ply", "format", "comment", "obj_info", "element", "property", "end_header")
SCENE_COMMENT = "scene_id type"
PLY_TYPES = {"float": "float", "int": "uchar", "double": "double"}
NUMPY_TYPES = {
    "char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2",
    "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8",
}
SPARK_TYPES = {"i1": "int", "u1": "int", "i2": "int", "u2": "int", "i4": "int", "u4": "bigint", "f4": "float", "f8": "double"}
ARROW_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}
FORMATS = {"ascii": "", "binary_little_endian": "<", "binary_big_endian": ">"}
MAX_HEADER = 1 << 20


@dataclass
class Element:
    name: str
    count: int
    properties: list[tuple[str, str]] = field(default_factory=list)  # (name, type)
    lists: bool = False  # a record has no fixed size


@dataclass
class Header:
    """A parsed header: its own size in bytes, the format, the elements, the scene id's type."""

    size: int
    format: str
    elements: list[Element]
    scene: str | None = None

    @property
    def vertex(self) -> Element:
        return next((e for e in self.elements if e.name == "vertex"), Element("vertex", 0))

    def before(self) -> list[Element]:
        """What stands in front of the vertices."""
        out = []
        for e in self.elements:
            if e.name == "vertex":
                return out
            if e.count:
                out.append(e)
        return out

    def after(self) -> bool:
        """Whether records follow the vertices."""
        names = [e.name for e in self.elements]
        own = names.index("vertex") if "vertex" in names else len(names)
        return any(e.count for e in self.elements[own + 1 :])

    def dtype(self, e: Element) -> np.dtype:
        return np.dtype([(n, FORMATS[self.format] + NUMPY_TYPES[t]) for n, t in e.properties])


def header_text(properties: list[tuple[str, str]], count: int, scene_type: str | None = None, form: str = "ascii") -> str:
    lines = ["ply", f"format {form} 1.0"]
    if scene_type:
        lines.append(f"comment {SCENE_COMMENT} {scene_type}")
    lines.append(f"element vertex {count}")
    lines += [f"property {t} {n}" for n, t in properties]
    lines.append("end_header")
    return "\n".join(lines) + "\n"


def parse_header(path: str, raw: bytes) -> Header:
    """The header at the start of ``raw``."""
    mark = raw.find(b"end_header")
    end = raw.find(b"\n", mark)
    if not raw.startswith(b"ply") or mark < 0 or end < 0:
        raise CloudError(f"not a PLY file: {path}")
    form, elements, scene = "", [], None
    for line in raw[:mark].decode("ascii", "replace").splitlines():
        parts = line.split()
        if parts[:1] == ["format"]:
            form = parts[1]
        elif parts[:1] == ["element"]:
            elements.append(Element(parts[1], int(parts[2])))
        elif parts[:1] == ["property"] and elements:
            if parts[1] == "list":
                elements[-1].lists = True
            elif parts[1] not in NUMPY_TYPES:
                raise CloudError(f"unknown property type {parts[1]}: {path}")
            elements[-1].properties.append((parts[-1], parts[1]))
        elif line.startswith(f"comment {SCENE_COMMENT} "):
            scene = line.strip()[len(f"comment {SCENE_COMMENT} ") :]
    if form not in FORMATS:
        raise CloudError(f"unknown PLY format {form!r}: {path}")
    out = Header(end + 1, form, elements, scene)
    if out.vertex.lists:
        raise CloudError(f"list properties in the vertex element are not supported: {path}")
    return out


def read_head(path: str) -> Header:
    """The header of a file; reads a few kilobytes."""
    from drapekit.sources.fs import arrow_fs

    fs, p = arrow_fs(path)
    with fs.open_input_stream(p) as f:
        head = b""
        while b"end_header" not in head or b"\n" not in head[head.find(b"end_header") :]:
            chunk = f.read(4096)
            if not chunk or len(head) > MAX_HEADER:
                break
            head += chunk
    return parse_header(path, head)


@dataclass
class Range:
    """Part of a file's vertices: ``rows`` records from byte ``start`` on (binary), or the lines
    that begin in start..end, of which the first ``skip`` are no vertices and at most ``rows``
    are (ASCII)."""

    start: int
    end: int
    rows: int
    skip: int = 0


def ranges(path: str, header: Header, size: int, wanted: int) -> list[Range]:
    """Ranges of about ``wanted`` bytes that together hold every vertex once."""
    vertex = header.vertex
    if not vertex.count:
        return []
    if header.format == "ascii":
        skip = sum(e.count for e in header.before())
        if skip or header.after():
            # which lines are vertices only shows by counting them from the start
            return [Range(header.size, size, vertex.count, skip)]
        cuts = [*range(header.size, size, max(1, wanted)), size]
        return [Range(a, b, vertex.count) for a, b in zip(cuts, cuts[1:])]
    start = header.size
    for e in header.before():
        if e.lists:
            raise CloudError(f"records of varying size before the vertices are not supported in binary files: {path}")
        start += e.count * header.dtype(e).itemsize
    stride = header.dtype(vertex).itemsize
    if start + vertex.count * stride > size:
        raise CloudError(f"{path} ends before its {vertex.count} vertices")
    step = max(1, wanted // max(1, stride))
    return [Range(start + k * stride, start + min(vertex.count, k + step) * stride, min(step, vertex.count - k)) for k in range(0, vertex.count, step)]


def _arrow(name: str, kind: str, values: np.ndarray) -> pa.Array:
    to = SPARK_TYPES[NUMPY_TYPES[kind]]
    return pa.array(np.ascontiguousarray(values).astype(ARROW_TYPES[to].to_pandas_dtype(), copy=False))


def read_binary(f, header: Header, part: Range, block: int):
    """Arrow columns of the records of ``part``, block by block."""
    dtype = header.dtype(header.vertex)
    step = max(1, block // dtype.itemsize)
    f.seek(part.start)
    for k in range(0, part.rows, step):
        n = min(step, part.rows - k)
        raw = f.read(n * dtype.itemsize)
        if len(raw) != n * dtype.itemsize:
            raise CloudError("a PLY file ends within its vertices")
        rows = np.frombuffer(raw, dtype)
        yield [_arrow(name, kind, rows[name]) for name, kind in header.vertex.properties]


def _lines(f, part: Range, block: int):
    """The whole lines that begin in the range, in blocks that end with a line."""
    f.seek(part.start)
    rest, at = b"", part.start
    while at < part.end:
        raw = f.read(min(block, part.end - at))
        if not raw:
            break
        at += len(raw)
        cut = raw.rfind(b"\n") + 1
        if cut:
            yield rest + raw[:cut]
            rest = raw[cut:]
        else:
            rest += raw
    if rest:  # the last line goes on behind the range
        while b"\n" not in rest:
            raw = f.read(4096)
            if not raw:
                break
            rest += raw
        yield rest[: rest.find(b"\n") + 1] if b"\n" in rest else rest + b"\n"


def read_ascii(f, header: Header, part: Range, block: int):
    """Arrow columns of the vertex lines that begin in ``part``."""
    start, skip, left = part.start, part.skip, part.rows
    if start > header.size:  # the line that the range begins within belongs to the one before
        f.seek(start - 1)
        while start <= part.end:
            raw = f.read(4096)
            cut = raw.find(b"\n")
            if cut >= 0:
                start = start + cut
                break
            if not raw:
                return
            start += len(raw)
        if start >= part.end:
            return
    for raw in map(_tidy, _lines(f, Range(start, part.end, part.rows), block)):
        if skip:
            n = raw.count(b"\n")
            if n <= skip:
                skip -= n
                continue
            raw, skip = raw.split(b"\n", skip)[skip], 0
        n = raw.count(b"\n")
        if n > left:
            raw = raw[: len(raw) - len(raw.split(b"\n", left)[left])]
        found = parse_lines(raw, header.vertex.properties)
        if found is None:
            continue
        left -= len(found[0])
        yield found
        if left <= 0:
            return


def _tidy(raw: bytes) -> bytes:
    """Lines with single spaces between numbers and none around them, empty lines left out."""
    if any(odd in raw for odd in (b"\r", b"\t", b"  ", b" \n", b"\n ", b"\n\n")) or raw[:1] in (b" ", b"\n"):
        raw = re.sub(rb" ?\n[ \n]*", b"\n", re.sub(rb"[ \t\r]+", b" ", raw)).lstrip(b" \n")
    return raw


def parse_lines(raw: bytes, properties: list[tuple[str, str]]) -> list[pa.Array] | None:
    """Columns of tidy text lines; a number that is none is null (NaN where the type has it)."""
    import pyarrow.csv as csv

    if not raw:
        return None
    kinds = {n: SPARK_TYPES[NUMPY_TYPES[t]] for n, t in properties}
    whole = [n for n, k in kinds.items() if k in ("int", "bigint")]
    convert = csv.ConvertOptions(column_types={n: ARROW_TYPES[k] for n, k in kinds.items()}, null_values=["nan", "NaN"])
    table = csv.read_csv(
        pa.BufferReader(raw),
        read_options=csv.ReadOptions(column_names=list(kinds), use_threads=False, block_size=len(raw) + 1),
        parse_options=csv.ParseOptions(delimiter=" ", quote_char=False, newlines_in_values=False),
        convert_options=convert,
    )
    out = []
    for n in kinds:
        column = table.column(n).combine_chunks()
        # text has no other null than nan
        out.append(column if n in whole else column.fill_null(float("nan")))
    return out


def pack(columns: list[pa.Array], properties: list[tuple[str, str]], form: str) -> np.ndarray:
    """Vertex records of Arrow columns; a null float is NaN, a null integer has no binary form."""
    dtype = np.dtype([(n, FORMATS[form] + NUMPY_TYPES[t]) for n, t in properties])
    out = np.empty(len(columns[0]), dtype)
    for (name, kind), column in zip(properties, columns):
        if column.null_count:
            if NUMPY_TYPES[kind][0] != "f":
                raise CloudError(f"null values of {name} cannot be written in a binary file")
            column = column.fill_null(float("nan"))
        out[name] = column.to_numpy(zero_copy_only=False)
    return out


def count_lines(f, start: int, block: int = 8 << 20) -> int:
    """Non-empty lines from byte ``start`` on."""
    f.seek(start)
    n, last = 0, 10
    while raw := f.read(block):
        data = np.frombuffer(raw, np.uint8)
        ends = data == 10
        before = np.concatenate([[last], data[:-1]])
        n += int((ends & (before != 10)).sum())
        last = int(data[-1])
    return n + (last != 10)
