"""Secret scans: patterns, and encoded keys and tokens that are confirmed by their structure.

Patterns find assignments, access ids and long hex runs. Base64 and hex text that could begin
a private key is decoded as far as its own outer length says, and reported only if all
nested lengths fit and the parts are those of a key. Text of dotted base64 parts is a token only if its header
names an algorithm and the other parts have the form and the sizes which that algorithm gives them.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.common import text_bytes

#: Kinds of spans, in the order in which spans of one start are listed: patterns, then confirmed structures.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "rsa", "dsa", "ec", "pkcs8", "pkcs8_encrypted", "openssh", "jws", "jwe")

ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
#: One of these stands in every assignment, in lower case.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
VALUE = 8

#: Outer parts of a key: a DER sequence, or the mark of an OpenSSH key.
OPENSSH = b"openssh-key-v1\0"
DER_64 = re.compile(rb"(?<![A-Za-z0-9+/_-])M[A-Za-z0-9+/_-]{23}")
DER_HEX = re.compile(rb"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{22}")
SSH_64 = re.compile(rb"b3BlbnNzaC1rZXktdjEA")
SSH_HEX = re.compile(rb"(?i)(?<![0-9a-f])6f70656e7373682d6b65792d763100")
#: How encoded text goes on behind a line's end, which may be written out as in a quoted string.
BREAK = re.compile(rb"[\x20\t]*(?:\r?\n|\\r\\n|\\n)[\x20\t]*")
RUN_64, RUN_HEX = re.compile(rb"[A-Za-z0-9+/_-]+"), re.compile(rb"[0-9A-Fa-f]+")
#: Bytes of the largest key that is looked for (an RSA key of 16,384 bits has under 10,000).
KEY_BYTES = 1 << 14

#: Three or five base64 parts of which the first begins like an encoded JSON object.
TOKEN = re.compile(rb"(?<![A-Za-z0-9_.-])e[yw][A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,}")
#: Bytes of a signature by its algorithm.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "none": 0}
#: Object identifiers under which keys are encrypted by a password (PKCS 5 and PKCS 12).
PASSWORD_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c"))

SPANS = "array<struct<kind: string, start: long, end: long>>"


# --- nested lengths -------------------------------------------------------------


def outer_length(head: bytes) -> int | None:
    """Bytes of the DER value that begins with ``head``, its tag and length included."""
    if len(head) < 2 or head[1] == 0x80:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    n = head[1] & 0x7F
    if n > 3 or len(head) < 2 + n or head[2] == 0 or (n == 1 and head[2] < 0x80):
        return None
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big")


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values side by side; None unless their lengths fill ``data`` to its end."""
    out, at = [], 0
    while at < len(data):
        whole = outer_length(data[at : at + 6])
        if whole is None or at + whole > len(data):
            return None
        first = at + 2 + (data[at + 1] & 0x7F if data[at + 1] & 0x80 else 0)
        out.append((data[at], data[first : at + whole]))
        at += whole
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with ``head``, if it goes on as a private key's does: with a version or a sequence."""
    size = outer_length(head)
    if size is None or head[0] != SEQUENCE:
        return None
    first = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    return size if head[first : first + 3] in (b"\x02\x01\x00", b"\x02\x01\x01") or head[first : first + 1] == b"\x30" else None


def der_key(data: bytes) -> str | None:
    """Which private key a DER value is, if any."""
    outer = der_items(data)
    if outer is None or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return None
    parts = der_items(outer[0][1])
    if not parts:
        return None
    tags = [tag for tag, _ in parts]
    if not all(content for tag, content in parts if tag == INTEGER):
        return None
    version = int.from_bytes(parts[0][1], "big") if tags[0] == INTEGER and len(parts[0][1]) == 1 else None
    if tags == [INTEGER] * 9 and version == 0 and len(parts[1][1]) >= 64:
        return "rsa"
    if tags == [INTEGER] * 6 and version == 0 and len(parts[1][1]) >= 64:
        return "dsa"
    if tags[:2] == [INTEGER, OCTETS] and version == 1 and set(tags[2:]) <= {0xA0, 0xA1} and 16 <= len(parts[1][1]) <= 72:
        return "ec" if all(der_items(content) for _, content in parts[2:]) else None
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and version in (0, 1) and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        named, inner = der_items(parts[1][1]), der_items(parts[2][1])
        held = bool(inner) and len(inner) == 1 and inner[0][0] in (SEQUENCE, OCTETS, INTEGER) and len(inner[0][1]) >= 16
        return "pkcs8" if held and named and named[0][0] == OID else None
    if tags == [SEQUENCE, OCTETS] and len(parts[1][1]) >= 16:
        named = der_items(parts[0][1])
        if named and [tag for tag, _ in named] == [OID, SEQUENCE] and named[0][1].startswith(PASSWORD_OIDS):
            return "pkcs8_encrypted"
    return None


def ssh_length(data: bytes) -> int | None:
    """Bytes of the OpenSSH key that ``data`` begins with; None if its nested lengths do not fit into ``data``."""

    def field(at: int) -> tuple[bytes, int] | None:
        n = int.from_bytes(data[at : at + 4], "big")
        return (data[at + 4 : at + 4 + n], at + 4 + n) if at + 4 + n <= len(data) else None

    at, found = len(OPENSSH), []
    for _ in range(3):  # cipher, derivation, its options
        part = field(at)
        if part is None:
            return None
        found.append(part[0])
        at = part[1]
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not found[0] or not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):  # public keys, then the private part
        part = field(at)
        if part is None or len(part[0]) < 8:
            return None
        at = part[1]
    if found[0] == b"none" and part[0][:4] != part[0][4:8]:  # a check number, twice
        return None
    return at


# --- candidates -----------------------------------------------------------------


def encoded(text: bytes, start: int, run: re.Pattern, most: int) -> Iterator[tuple[int, int]]:
    """Spans of encoded characters from ``start`` on, over line ends, at most ``most`` characters in all."""
    at = start
    while most > 0:
        part = run.match(text, at)
        if part is None:
            return
        end = min(part.end(), at + most)
        yield at, end
        most -= end - at
        if end < part.end():
            return
        gap = BREAK.match(text, end)
        if gap is None:
            return
        at = gap.end()


def unpacked(chars: bytes, hexed: bool) -> bytes:
    if hexed:
        return bytes.fromhex(chars[: len(chars) // 2 * 2].decode())
    whole = chars.translate(bytes.maketrans(b"-_", b"+/"))
    whole = whole[:-1] if len(whole) % 4 == 1 else whole
    return base64.b64decode(whole + b"=" * (-len(whole) % 4))


def key_at(text: bytes, start: int, hexed: bool, ssh: bool) -> tuple[str, int] | None:
    """(kind, end) of the private key whose encoding starts at ``start``."""
    run = RUN_HEX if hexed else RUN_64
    size: int | None = KEY_BYTES
    if not ssh:
        size = der_size(unpacked(text[start : start + 24], hexed))
        if size is None or size > KEY_BYTES:
            return None
    spans = list(encoded(text, start, run, size * 2 if hexed else -(-size * 8 // 6)))
    chars = b"".join(text[a:b] for a, b in spans)
    whole = unpacked(chars, hexed)
    if ssh:
        size = ssh_length(whole)
    if size is None or size > len(whole):
        return None
    kind = "openssh" if ssh else der_key(whole[:size])
    if kind is None:
        return None
    needed = size * 2 if hexed else -(-size * 8 // 6)
    for a, b in spans:
        if needed <= b - a:
            break
        needed -= b - a
    end = a + needed
    if run.match(text, end):  # the encoded text runs on, so it was not this
        return None
    if not hexed:
        while end < len(text) and text[end] == 61 and end - a - needed < 2:
            end += 1
    return kind, end


def json_object(part: bytes) -> dict | None:
    if len(part) % 4 == 1:
        return None
    try:
        found = json.loads(unpacked(part, False))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def token_kind(text: bytes) -> str | None:
    """Whether dotted base64 parts are a signed or an encrypted token."""
    parts = text.split(b".")
    header = json_object(parts[0])
    if header is None or not isinstance(header.get("alg"), str) or any(len(p) % 4 == 1 for p in parts):
        return None
    sizes = [len(p) * 6 // 8 for p in parts]
    if len(parts) == 3 and json_object(parts[1]) is not None:
        named = SIGNATURES.get(header["alg"])
        if named is None:
            named = sizes[2] if sizes[2] >= (128 if header["alg"][:2] in ("RS", "PS") else 1) else -1
        return "jws" if sizes[2] == named else None
    if len(parts) == 5 and isinstance(header.get("enc"), str) and sizes[2] in (12, 16) and sizes[4] in (16, 24, 32) and sizes[3]:
        return "jwe"
    return None


KEYS: tuple[tuple[re.Pattern, bool, bool], ...] = ((DER_64, False, False), (DER_HEX, True, False), (SSH_64, False, True), (SSH_HEX, True, True))


def spans_of(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start and then by kind; of confirmed keys of one form, those that do not overlap."""
    found: list[tuple[str, int, int]] = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= VALUE]
    del lower
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for pattern, hexed, ssh in KEYS:
        at = 0
        while (start := pattern.search(text, at)) is not None:
            key = key_at(text, start.start(), hexed, ssh)
            if key is not None:
                found.append((key[0], start.start(), key[1]))
            at = start.start() + 1 if key is None else key[1]
    for m in TOKEN.finditer(text):
        kind = token_kind(m.group())
        if kind is not None:
            found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def code_points(data: np.ndarray, places: list[int]) -> dict[int, int]:
    """The code points before each of some byte places of UTF-8 text."""
    out, at, count = {}, 0, 0
    for place in sorted(set(places)):
        while at < place:
            end = min(place, at + (1 << 20))
            count += int(np.count_nonzero((data[at:end] & 0xC0) != 0x80))
            at = end
        out[place] = count
    return out


def scan_udf() -> Callable:
    """text -> spans in code points; a null text has none."""

    @arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, bounds = text_bytes(texts)
            kinds: list[str] = []
            starts: list[int] = []
            ends: list[int] = []
            offsets = [0]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                own = data[low:high]
                spans = spans_of(own.tobytes())
                at = code_points(own, [p for _, a, b in spans for p in (a, b)])
                kinds += [k for k, _, _ in spans]
                starts += [at[a] for _, a, _ in spans]
                ends += [at[b] for _, _, b in spans]
                offsets.append(len(kinds))
            fields = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["kind", "start", "end"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)

    return scan


def scanned(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id`` and ``secrets``: spans (kind, start, end) in code points, by start and then in the order of ``KINDS``.

    Patterns of one kind do not overlap; a confirmed key or token is listed beside the patterns
    that it holds. A text is scanned whole, however long; memory grows with the longest text alone.
    Null and empty texts have no spans; equal rows are each reported; an empty table gives no rows;
    other columns are not read. Keys whose text is encrypted outside of their encoding (``Proc-Type``) have no
    structure to confirm and are not reported.
    """
    return docs.select("doc_id", scan_udf()(F.col("text")).alias("secrets"))
