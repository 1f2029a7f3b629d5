"""Secret scan with structural confirmation.

Patterns find the base spans (assigned values, access ids, long hex).  Runs
that could be base64 or hex are decoded and only reported if what they decode
to has the structure of a secret:

* ``pem``: an armoured private key whose body decodes to a key structure, or
  base64 of text that holds one; without its END line (or with another's) it
  goes as far as the key, or if that is cut off, as its base64 lines;
* ``der``: base64 or hex of a DER key: nested lengths that fill their parents
  exactly, with the integers, octet strings or identifiers of a private key;
* ``ssh``: the length-prefixed fields of an OpenSSH private key;
* ``jwt``: three base64url parts whose header is a JSON object with ``alg``
  and whose payload is a JSON object.

Candidates may be wrapped: lines of the alphabet, indented or not and with line
ends that may be escaped, are joined, and a key may begin at any of them and
ends with a line's part.  Not seen are lines with other prefixes (quotes,
comment signs), DER keys that are cut off without armour, and coded armour not
at the start of its lines and in lines of less than 20 symbols.

Spans are (kind, start, end) in code points, end exclusive; a text's spans are
ordered by start, then by kind as listed in ``KINDS``.

Of a run every alignment is decoded once, however many beginnings of keys it
has, so a text costs about its length.

Defined results: a null text is an empty one, without spans; repeated rows
give repeated results; other columns are kept and an input column with the
name of a result column is replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
BASE_KINDS = KINDS[:3]

#: The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
#: A JSON object begins with "e" in base64.  Looked ahead only, so that a word
#: and a dot before a token do not use up its parts.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=(e[A-Za-z0-9_-]{7,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]*))")

#: Runs of the base64 and hex alphabets over any number of lines (line ends also
#: escaped, as in JSON), and where such a run could begin with a key or armour.
NEWLINE = r"[ \t]*+(?:\r\n?|\n|\\r\\n|\\n)[ \t]*+"
LINES = re.compile(rf"[A-Za-z0-9+/_-]++(?:{NEWLINE}[A-Za-z0-9+/_-]++)*+={{0,2}}")
HEX_LINES = re.compile(rf"[0-9A-Fa-f]++(?:{NEWLINE}[0-9A-Fa-f]++)*+")
RUN, HEX_RUN = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
BEGINS = re.compile(r"M[A-P]|b3Bl|LS0t|[A-Za-z0-9+/_-]{20}")
HEX_BEGINS = re.compile(r"30[0-9A-Fa-f]{2}|6[fF]70656[eE]")
LINE_ENDS = re.compile(r"""[ \t]*+(?:[\r\n\\"'<]|\Z)""")
ARMOUR_HEADERS = re.compile(rf"(?:{NEWLINE}[A-Za-z-]+:[^\r\n\\]*+)*+(?:{NEWLINE})*+[ \t]*+")
LEAST_CODED, LEAST_HEX = 44, 48

SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPAN_SCHEMA = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType()))

#: DER tags (fixed values).
INTEGER, BIT_STRING, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def unbase64(run: str) -> bytes:
    """Standard or URL alphabet, padded or not; b'' if it is neither."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return b""
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the items that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """A private key of the RSA/DSA, EC or PKCS #8 layout, also encrypted."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = der_items(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags[:1] == [INTEGER] and len(tags) >= 6 and set(tags) <= {INTEGER, SEQUENCE}:  # RSA, DSA
        return max(len(c) for _, c in inner) >= 16
    if tags[:2] == [INTEGER, OCTETS]:  # EC
        return inner[0][1] == b"\x01" and len(inner[1][1]) >= 16
    algorithm = next((c for t, c in inner[:2] if t == SEQUENCE), None)
    named = (der_items(algorithm) or [(0, b"")]) if algorithm is not None else [(0, b"")]
    if named[0][0] != OBJECT_ID:
        return False
    return tags[:3] == [INTEGER, SEQUENCE, OCTETS] or tags == [SEQUENCE, OCTETS]  # PKCS #8, plain and encrypted


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with ``head`` (six bytes, or all there are)."""
    if len(head) < 2 or head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F
    if not head[1] & 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(head[2:2 + n], "big") if 1 <= n <= 4 and len(head) >= 2 + n else None


def begins_der_key(data: bytes) -> bool:
    """A DER key that was cut off: longer than ``data``, which has the start of one."""
    size = der_size(data[:6])
    if size is None or size <= len(data) or len(data) < 24:
        return False
    inner = data[2 + (data[1] & 0x7F if data[1] & 0x80 else 0):]
    if inner[:2] == b"\x02\x01":  # version, then a number, an octet string or the algorithm
        return inner[3] in (INTEGER, OCTETS, SEQUENCE)
    return inner[0] == SEQUENCE and der_size(inner[:6]) is not None and inner[2] == OBJECT_ID


SSH_MAGIC = b"openssh-key-v1\0"


def ssh_fields(data: bytes, start: int = 0) -> int | None:
    """Where the cipher, KDF and KDF options of the OpenSSH key at ``start`` end."""
    if not data.startswith(SSH_MAGIC, start):
        return None
    at = start + len(SSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at if at + 4 <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_fields(data) is not None


def ssh_size(data: bytes, start: int = 0) -> int | None:
    """Bytes of the OpenSSH key at ``start``; None if its private part is empty or cut off."""
    at = ssh_fields(data, start)
    fields = 1 + int.from_bytes(data[at:at + 4], "big")  # public keys and the private part
    at += 4
    for _ in range(fields):
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4 + size
    return at - start if size and at <= len(data) else None


def is_signed_token(header: str, payload: str) -> bool:
    try:
        head, body = json.loads(unbase64(header)), json.loads(unbase64(payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def key_kind(data: bytes) -> str | None:
    return "ssh" if is_ssh_key(data) else "der" if is_der_key(data) else None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


class Lines:
    """A run over lines that begins at ``start``: its symbols without line ends,
    and where in these and in the text every line's part ends."""

    def __init__(self, text: str, start: int, lines: re.Pattern, run: re.Pattern):
        self.text, self.stop = text, lines.match(text, start).end()
        parts, self.starts, self.ends, self.at = [], [], [], [0]
        while start < self.stop:
            if text[start] == "\\":  # an escaped line end
                start += 2
            elif m := run.match(text, start, self.stop):
                parts.append(m[0])
                self.starts.append(start)
                self.ends.append(start := m.end())
                self.at.append(self.at[-1] + len(m[0]))
            else:
                start += 1
        self.symbols = "".join(parts)
        self.read, self.armour = {}, {}

    def decoded(self, first: int, decode) -> tuple[bytes, int]:
        """What the symbols decode to, each alignment once, and where those after ``first`` begin in it."""
        symbols, size = (4, 3) if decode is unbase64 else (2, 1)
        lead = first % symbols
        if lead not in self.read:
            self.read[lead] = decode(whole_symbols(self.symbols[lead:]))
        return self.read[lead], (first - lead) // symbols * size

    def armour_end(self, first: int) -> int | None:
        """Bytes from the first symbol after ``first`` to the end of the last armoured key in what they decode to."""
        data, start = self.decoded(first, unbase64)
        lead = first % 4
        if lead not in self.armour:
            self.armour[lead] = last_keys(data.decode("latin-1")) if b"PRIVATE KEY-----" in data else ([], [])
        begins, lasts = self.armour[lead]
        i = bisect_left(begins, start)
        return lasts[i] - start if i < len(begins) and lasts[i] is not None else None

    def offset(self, place: int) -> int | None:
        """Number of symbols before ``place``, the start of a line's part."""
        i = bisect_left(self.starts, place)
        return self.at[i] if i < len(self.starts) and self.starts[i] == place else None

    def end(self, symbols: int, exact: bool) -> int | None:
        """End in the text of the line's part that holds the last of so many symbols
        (exact: ends with it), with the padding."""
        i = bisect_left(self.at, symbols, 1)
        if i == len(self.at) or exact and self.at[i] != symbols:
            return None
        return padded(self.text, self.ends[i - 1])

    def whole(self, first: int) -> int:
        """Number of symbols up to the end of the last line that has nothing else,
        at least those of the line's part that begins after ``first`` symbols."""
        last = padded(self.text, self.ends[-1])
        return self.at[-1] if LINE_ENDS.match(self.text, last) or self.at[-2] <= first else self.at[-2]


def padded(text: str, end: int) -> int:
    return end + len(text[end:end + 2]) - len(text[end:end + 2].lstrip("="))


def key_in_lines(lines: Lines, first: int, decode, bytes_to_symbols, least: int) -> tuple[str, int] | None:
    """Kind and end in the text of the key that begins after ``first`` symbols."""
    symbols = lines.symbols
    size = der_size(decode(symbols[first:first + 16])[:6])
    if size is not None:
        n = bytes_to_symbols(size)
        if n >= least and (end := lines.end(first + n, exact=least > 0)):
            data, start = lines.decoded(first, decode)
            if is_der_key(memoryview(data)[start:start + size]):
                return "der", end
        return None
    if not decode(symbols[first:first + 32]).startswith(SSH_MAGIC):
        return None
    data, start = lines.decoded(first, decode)
    if ssh_fields(data, start) is None:
        return None
    size = ssh_size(data, start)
    return "ssh", lines.end(lines.whole(first) if size is None else first + bytes_to_symbols(size), False)


def boundary(text: str, at: int, run: re.Pattern) -> bool:
    """No symbol of ``run`` is before ``at``, but for the letter of an escaped line end."""
    return at == 0 or not run.match(text[at - 1]) or at > 1 and text[at - 2] == "\\" and text[at - 1] in "nr"


def armoured(text: str) -> list[tuple[int, int]]:
    """Armoured keys; without its END line one goes as far as its base64 lines."""
    return [(m.start(), end) for m in BEGIN.finditer(text) if (end := armoured_end(text, m)) is not None]


def armoured_end(text: str, begin: re.Match) -> int | None:
    """End of the armoured key with this BEGIN line, None if it holds none."""
    stop, closing = text.find("-----", begin.end()), f"-----END {begin[1]}-----"
    if stop >= 0 and text.startswith(closing, stop):
        within = text[begin.end():stop]
        body = re.sub(r"(?m)^[A-Za-z-]+:.*$", "", within)  # headers of an encrypted key
        data = unbase64(re.sub(r"\s|\\n|\\r", "", body))
        return stop + len(closing) if key_kind(data) or "ENCRYPTED" in within and len(data) >= 32 else None
    headers = ARMOUR_HEADERS.match(text, begin.end())
    if not RUN.match(text, headers.end()):
        return None
    lines = Lines(text, headers.end(), LINES, RUN)
    if found := key_in_lines(lines, 0, unbase64, coded_length, 0):
        return found[1]
    n = lines.whole(0)
    data = unbase64(whole_symbols(lines.symbols[:n]))
    if begins_der_key(data) or data.startswith(SSH_MAGIC) or "ENCRYPTED" in headers[0] and len(data) >= 32:
        return lines.end(n, False)
    return None


def last_keys(text: str) -> tuple[list[int], list[int | None]]:
    """Every BEGIN line of ``text`` and, for each, the end of the last of the keys
    that ``armoured`` finds from there on."""
    begins, found, at = [], [], 0
    while m := BEGIN.search(text, at):
        begins.append(m.start())
        found.append((m.end(), armoured_end(text, m)))
        at = m.start() + 1
    lasts = [None] * len(begins)
    for i in reversed(range(len(begins))):
        behind = bisect_left(begins, found[i][0])
        later = lasts[behind] if behind < len(begins) else None
        lasts[i] = found[i][1] if later is None else later
    return begins, lasts


def coded_length(size: int) -> int:
    return -(-4 * size // 3)


def whole_symbols(run: str) -> str:
    """Without a last symbol that is no whole byte."""
    return run[:-1] if len(run) % 4 == 1 else run


def unhex(run: str) -> bytes:
    return bytes.fromhex(run[:len(run) - len(run) % 2])


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """What the structure of the decoded candidates confirms."""
    out = []
    if "PRIVATE KEY-----" in text:
        out += [("pem", *s) for s in armoured(text)]
    if "." in text:
        out += [("jwt", m.start(), m.end(3)) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    covered = sorted((a, b) for _, a, b in out)
    starts, furthest = [a for a, _ in covered], list(accumulate((b for _, b in covered), max))
    for begins, pattern, run, decode, length, least in (
            (BEGINS, LINES, RUN, unbase64, coded_length, LEAST_CODED), (HEX_BEGINS, HEX_LINES, HEX_RUN, unhex, lambda n: 2 * n, LEAST_HEX)):
        lines, at = None, 0
        while m := begins.search(text, at):
            start = m.start()
            if start and text[start - 1] == "\\" and m[0][0] in "nr":  # the letter of an escaped line end
                at = start + 1
                continue
            at = run.match(text, start).end()
            before = bisect_right(starts, start)
            if not boundary(text, start, run) or before and at <= furthest[before - 1]:
                continue
            fresh = lines is None or lines.offset(start) is None
            if fresh:
                lines = Lines(text, start, pattern, run)
            first = lines.offset(start)
            if lines.at[-1] - first < least:
                continue
            if begins is HEX_BEGINS or m[0][0] in "Mb":
                # DER begins with the tag of a sequence (base64 "M"), SSH keys with "b3Bl".
                if found := key_in_lines(lines, first, decode, length, least):
                    out.append((found[0], start, found[1]))
                    at = max(at, found[1])
                    continue
            if begins is BEGINS and (fresh or m[0] == "LS0t"):
                if (size := lines.armour_end(first)) is not None:
                    out.append(("pem", start, end := lines.end(first + coded_length(size), False)))
                    at = max(at, end)
    return out


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    if not text:
        return []
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str | None, spans) -> str | None:
    """``text`` with each span (overlapping ones joined) replaced by [kind]."""
    if not spans:
        return text
    out, at, end, kind = [], 0, -1, ""
    for k, a, b in spans:
        if a >= end:
            if kind:
                out.append(f"[{kind}]")
            out.append(text[max(at, end):a] if end >= 0 else text[:a])
            kind, end = k, b
        else:
            end = max(end, b)
        at = end
    return "".join([*out, f"[{kind}]", text[end:]])


@F.arrow_udf(SPAN_SCHEMA)
def spans_column(texts: pa.Array) -> pa.Array:
    found = ([{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts.to_pylist())
    return pa.array(list(found), SPAN_TYPE)


@F.arrow_udf(T.StringType())
def redact_column(texts: pa.Array) -> pa.Array:
    return pa.array([redacted(t, find_spans(t)) for t in texts.to_pylist()], pa.string())


def scan(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with ``spans``: array of (kind, start, end)."""
    return df.withColumn(spans, spans_column.asNondeterministic()(F.col(text)))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets."""
    return df.withColumn(text, redact_column(F.col(text)))


def span_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = scan(documents.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
