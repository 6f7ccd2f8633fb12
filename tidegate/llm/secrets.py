"""Secret scans: patterns find candidates, their structure confirms more.

Three base kinds are patterns: `assign`, `access`, `hex`. The other kinds are
reported only after a candidate has been decoded and parsed to its end:

* `pem`: a block between armour lines whose body is base64 of a DER or SSH key, of
  packets that begin with an OpenPGP key, or of whole cipher blocks if its headers say
  how it is encrypted; line breaks may be written as backslash and n;
* `der`: base64, also wrapped in lines of one width, or hex of a DER key;
* `ssh`: the same of an SSH key, every length field fitting;
* `jwt`: a signed token, its header JSON with an algorithm, its payload JSON.

A DER key is a sequence whose parts nest with exact lengths. It starts with an integer
as RSA, DSA, EC, PKCS#8 private keys do, or is an algorithm identifier with a bit
string, as public keys are, or one of password encryption with an octet string. A
candidate begins at any place whose first bytes can begin a key, so what stands before it
in the same run (`key-`, `path/`, `0x`) does not hide it; it ends where its length says,
which must be where a line of the run ends. Keys inside a `pem` span are not reported
again. A run of fewer than LEAST_KEY bytes holds no key.

Armour is read up to the next five dashes, so padded text takes linear time.

Spans are in code points, the end exclusive, sorted by start and then kind in the
order of KINDS. Defined results: null and empty texts have no spans; rows that
repeat get a row each; other columns are left alone.
"""

import base64
import binascii
import bisect
import itertools
import json
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.tasks import map_texts
from tidegate.llm.text import byte_arrays, lower_ascii

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("pem", "der", "ssh", "jwt")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9][A-Z0-9 ]*)-----")
JWT = re.compile(
    r"(?<![A-Za-z0-9_-])((?:e[w-z0-9_-]|I[A-P]|C[Q-Za-v]|D[Q-Za-f])[A-Za-z0-9_-]+)(?=\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+))"
)
LEAST_KEY = 24  # bytes
LEAST_CODES, LEAST_DIGITS = LEAST_KEY * 4 // 3, LEAST_KEY * 2
LEAST_HEADER = 14  # codes of the shortest JSON object that names an algorithm

# How keys and their encodings begin.
SSH_MAGIC = b"openssh-key-v1\0"
SSH_KIND = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+")
PASSWORD_ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))  # PKCS#5, PKCS#12
CODED_START = re.compile(r"M[A-P]|AAAA[B-Z]|b3BlbnNzaC1rZXktdjE")
DIGITS_START = re.compile(r"30|000000[0-9a-f]{2}(?:7373682d|65636473|736b2d)|6f70656e7373682d6b65792d7631", re.IGNORECASE)
ENCRYPTED = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,[0-9A-Fa-f]+")

HEX_BYTE = np.zeros(256, bool)
HEX_BYTE[list(b"0123456789abcdef")] = True
DIGIT_BYTE = HEX_BYTE.copy()
DIGIT_BYTE[list(b"ABCDEF")] = True
CODE_BYTE = np.zeros(256, bool)
CODE_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
LINE = re.compile(rb"[A-Za-z0-9+/_-]+")
BREAK = re.compile(rb"\r?\n[ \t]*|(?:\\r)?\\n")

SPAN = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def der_head(data: bytes | memoryview, at: int) -> tuple[int, int] | None:
    """Where the content of the part at `at` begins and ends, or None if its length is not written as it must be."""
    if at + 2 > len(data):
        return None
    size, at = data[at + 1], at + 2
    if size >= 0x80:
        wide = size & 0x7F
        if not 1 <= wide <= 4 or at + wide > len(data) or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at : at + wide], "big"), at + wide
        if size < 0x80:
            return None
    return at, at + size


def der_parts(data: bytes | memoryview) -> list[tuple[int, memoryview]] | None:
    """The tags and contents that fill `data`, or None if lengths do not nest."""
    view, parts, at = memoryview(data), [], 0
    while at < len(view):
        bounds = der_head(view, at)
        if bounds is None or bounds[1] > len(view):
            return None
        parts.append((view[at], view[bounds[0] : bounds[1]]))
        at = bounds[1]
    return parts


def is_der_key(data: bytes) -> bool:
    outer = der_parts(data) if data[:1] == b"\x30" else None
    if outer is None or len(outer) != 1:
        return False
    parts = der_parts(outer[0][1])
    if not parts or len(parts) < 2 or len(data) < LEAST_KEY:
        return False
    tags = [tag for tag, _ in parts]
    if tags[0] == 0x02:  # a private key: version, then numbers, an octet string or an algorithm
        if parts[0][1] not in (b"\x00", b"\x01"):
            return False
        if tags[1] == 0x30:
            return len(tags) >= 3 and tags[2] == 0x04 and is_algorithm(parts[1][1])
        if tags[1] == 0x04 or len(tags) >= 9 and set(tags[:9]) == {0x02}:
            return True
        return tags == [0x02] * 6 and len(parts[1][1]) >= 16  # DSA: its modulus is no small number
    if tags == [0x30, 0x04]:
        return len(parts[1][1]) > 0 and is_algorithm(parts[0][1], PASSWORD_ENCRYPTION)
    return tags == [0x30, 0x03] and is_algorithm(parts[0][1])


def is_algorithm(data: bytes | memoryview, names: tuple[bytes, ...] = (b"",)) -> bool:
    parts = der_parts(data)
    return bool(parts) and parts[0][0] == 0x06 and len(parts[0][1]) >= 3 and bytes(parts[0][1]).startswith(names)


def is_ssh_key(data: bytes) -> bool:
    if data.startswith(SSH_MAGIC):
        names = []
        at = len(SSH_MAGIC)
        for _ in range(3):  # cipher, derivation and its options
            name, at = ssh_string(data, at)
            if name is None:
                return False
            names.append(name)
        if at + 4 > len(data):
            return False
        count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        for _ in range(count + 1):  # the public keys and the private part; each takes four bytes or ends this
            part, at = ssh_string(data, at)
            if part is None:
                return False
        return count > 0 and names[0].isascii()
    kind, at = ssh_string(data, 0)
    if kind is None or not SSH_KIND.fullmatch(kind):
        return False
    fields = 0
    while at < len(data):
        part, at = ssh_string(data, at)
        if part is None:
            return False
        fields += 1
    return fields >= 1


def is_pgp_key(data: bytes) -> bool:
    """Packets that fill `data`, the first a secret or public key of a known version."""
    at, first = 0, True
    while at < len(data):
        mark, at = data[at], at + 1
        if not mark & 0x80:
            return False
        if mark & 0x40:
            tag, wide = mark & 0x3F, 1
            if at < len(data) and data[at] >= 192:
                wide = 2 if data[at] < 224 else 5 if data[at] == 255 else 0
        else:
            tag, wide = mark >> 2 & 0x0F, (1, 2, 4, 0)[mark & 3]
        if not wide or at + wide > len(data):
            return False
        if mark & 0x40 and wide == 2:
            size = (data[at] - 192 << 8) + data[at + 1] + 192
        else:
            size = int.from_bytes(data[at + (wide == 5) : at + wide], "big")
        at += wide
        if at + size > len(data) or first and (tag not in (5, 6) or not size or data[at] not in (3, 4, 5, 6)):
            return False
        at, first = at + size, False
    return not first


def ssh_string(data: bytes, at: int) -> tuple[bytes | None, int]:
    if at + 4 > len(data):
        return None, at
    stop = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return (data[at + 4 : stop], stop) if stop <= len(data) else (None, at)


def decode_base64(text: str) -> bytes | None:
    """Standard or URL-safe base64, padded or not; None if it is neither."""
    body = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, payload: str) -> bool:
    try:
        head = json.loads(decode_base64(header) or b"")
        body = json.loads(decode_base64(payload) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def is_armoured_key(body: str) -> bool:
    """Whether the text between armour lines holds a key: headers up to a blank line, base64, perhaps a checksum."""
    lines = [line.strip() for line in body.replace("\\r", "").replace("\\n", "\n").strip().splitlines()]
    headers = []
    if lines and ":" in lines[0]:
        blank = lines.index("") if "" in lines else len(lines)
        headers, lines = lines[:blank], lines[blank:]
    if lines and re.fullmatch("=[A-Za-z0-9+/]{4}", lines[-1]):
        lines.pop()
    data = decode_base64("".join(lines))
    if not data:
        return False
    if any(ENCRYPTED.fullmatch(line) for line in headers):
        return len(data) >= LEAST_KEY and len(data) % 8 == 0
    return is_der_key(data) or is_ssh_key(data) or is_pgp_key(data)


def armoured_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in ARMOUR.finditer(text):
        stop = text.find("-----", m.end())
        last = f"-----END {m[1]}-----"
        if stop >= 0 and text.startswith(last, stop) and is_armoured_key(text[m.end() : stop]):
            yield "pem", m.start(), stop + len(last)


def wrapped_lines(raw: bytes, start: int, stop: int, end: int) -> list[tuple[int, int]]:
    """The byte range of a run and of the lines that go on with it: of one width, the last may be shorter."""
    lines, width = [(start, stop)], 0
    while True:
        gap = BREAK.match(raw, stop, end)
        line = LINE.match(raw, gap.end(), end) if gap else None
        size = line.end() - line.start() if line else 0
        if not line or width and size > width:
            return lines
        lines.append(line.span())
        stop = line.end()
        if width and size < width:
            return lines
        width = size


def keys_in(codes: str, ends: list[int], begin: re.Pattern, decode: Callable[[str], bytes | None], ratio: float):
    """Keys in an encoded text as (kind, start, end); a key ends at one of `ends`, `ratio` being codes per byte."""
    after, stops = 0, set(ends)
    for m in begin.finditer(codes):
        at = m.start()
        if at < after:
            continue
        if m.end() - at == 2:  # a DER sequence, whose length says where it ends
            head = decode(codes[at : at + 16])
            bounds = der_head(head, 0) if head else None
            stop = at + math.ceil(bounds[1] * ratio) if bounds else -1
            if stop not in stops or stop - at < LEAST_KEY * ratio:
                continue
            tries = [(stop, "der", is_der_key)]
        else:  # up to the end of its line or of the run, whose last line may be no part of it
            tries = [(stop, "ssh", is_ssh_key) for stop in (ends[bisect.bisect_right(ends, at)], *ends[-2:]) if stop > at]
        for stop, kind, confirms in tries:
            data = decode(codes[at:stop])
            if data and confirms(data):
                yield kind, at, stop
                after = stop
                break


def decode_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def class_runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the longest runs of member bytes within a text, at least `least` long."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate(([0], change))
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    inner = inner[inside[inner] & inside[inner - 1]]  # texts that meet within a run
    starts = np.sort(np.concatenate((change[0::2], inner)))
    stops = np.sort(np.concatenate((change[1::2], inner)))
    long = stops - starts >= least
    return starts[long], stops[long]


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the kinds that need the text itself."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += armoured_spans(text)
    spans += [("jwt", m.start(), m.end(3)) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    return spans


def spans_of_run(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
    """All spans of each text, sorted."""
    data, offsets = byte_arrays(texts)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    found: list[list[tuple[str, int, int]]] = [[] for _ in range(len(texts))]

    def owner(at) -> np.ndarray:
        return np.searchsorted(offsets, at, side="right") - 1

    low, raw = lower_ascii(data).tobytes(), data.tobytes()
    marks = [(low, word) for word in KEYWORDS] + [(raw, word) for word in (b"AKIA", b"-----BEGIN ")]
    named: set[int] = set()
    for inside, word in marks:
        at = inside.find(word)
        while at >= 0:
            i = int(owner(at))
            named.add(i)
            at = inside.find(word, int(offsets[i + 1]))
    starts, stops = class_runs(data, offsets, CODE_BYTE, LEAST_HEADER)
    dotted = stops[(stops < len(data)) & (data[np.minimum(stops, len(data) - 1)] == ord("."))] if len(data) else stops
    dotted = dotted[owner(dotted) == owner(dotted - 1)]
    named.update(owner(dotted).tolist())
    for i in named:
        found[i] += pattern_spans(texts[i].as_py())

    def place(i: int, at: int) -> int:
        return int(before[at] - before[offsets[i]])

    hex_starts, hex_stops = class_runs(data, offsets, HEX_BYTE, HEX_LENGTH)
    for i, start, stop in zip(owner(hex_starts).tolist(), hex_starts.tolist(), hex_stops.tolist()):
        found[i].append(("hex", place(i, start), place(i, stop)))

    keys: list[list[tuple[str, int, int]]] = [[] for _ in range(len(texts))]
    long, done = stops - starts >= LEAST_CODES, 0
    for i, start, stop in zip(owner(starts[long]).tolist(), starts[long].tolist(), stops[long].tolist()):
        if start < done:
            continue  # a line of the run before
        end = int(offsets[i + 1])
        lines = wrapped_lines(raw, start, stop, end)
        done = lines[-1][1]
        ends = list(itertools.accumulate(b - a for a, b in lines))
        codes = b"".join(raw[a:b] for a, b in lines).decode()
        for kind, a, b in keys_in(codes, ends, CODED_START, decode_base64, 4 / 3):
            first, last = bisect.bisect_right(ends, a), bisect.bisect_left(ends, b)
            a, b = lines[first][1] - (ends[first] - a), lines[last][1] - (ends[last] - b)
            while b < min(lines[last][1] + 2, end) and raw[b] == ord("="):
                b += 1
            keys[i].append((kind, place(i, a), place(i, b)))
    starts, stops = class_runs(data, offsets, DIGIT_BYTE, LEAST_DIGITS)
    for i, start, stop in zip(owner(starts).tolist(), starts.tolist(), stops.tolist()):
        for kind, a, b in keys_in(raw[start:stop].decode(), [stop - start], DIGITS_START, decode_hex, 2):
            keys[i].append((kind, place(i, start + a), place(i, start + b)))
    for spans, inner in zip(found, keys):
        blocks = [(a, b) for kind, a, b in spans if kind == "pem"]  # in order, none within another
        for key in inner:
            at = bisect.bisect_right(blocks, (key[1], len(data))) - 1
            if at < 0 or blocks[at][1] < key[2]:
                spans.append(key)
    for spans in found:
        spans.sort(key=lambda span: (span[1], ORDER[span[0]], span[2]))
    return found


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per document: doc_id and its spans."""

    def scan(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in spans_of_run(texts)]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, SPAN_TYPE)], ["doc_id", "spans"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, scan, f"doc_id bigint, spans {SPAN}")


def span_text(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
