"""Secret scans with structural confirmation.

Plain patterns find candidates; what the method adds is reported only if its structure holds: base64 or hex is
decoded and parsed as a DER key (nested lengths must add up), as an OpenSSH key (length-prefixed fields), as a
signed token (its header must be a JSON object that names an algorithm), or has a checksum that fits.

Kinds of the base: assign, access, hex. Kinds that are added: pem, der, openssh, jwt, checked.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns as the contract gives them; only the letters of the names are of either case.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join(re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", n) for n in _NAMES)
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "jwt", "checked")
_RANK = {k: i for i, k in enumerate(KINDS)}

_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}(?![A-Za-z0-9+/_=-])")
_HEX_RUN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){24,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){24,}(?![0-9A-Za-z])")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----((?:(?!-----BEGIN ).)*?)-----END \1-----", re.DOTALL)
#: Line ends in a PEM body, real or escaped as in JSON (once or more often), and a header line with its continuations.
_BREAK = re.compile(r"\\+r\\+n|\\+[nr]|\r\n?")
_HEADER = re.compile(r"(?m)^[\x20\t]*[A-Za-z][A-Za-z0-9-]*:.*(?:\n[\x20\t]+\S.*)*")
_ENCRYPTED = re.compile(r"(?m)^[\x20\t]*Proc-Type:[\x20\t]*4,[\x20\t]*ENCRYPTED[\x20\t]*$")
_CIPHER = re.compile(r"(?m)^[\x20\t]*DEK-Info:[\x20\t]*([A-Z0-9-]+),[\x20\t]*([0-9A-Fa-f]{16,32})[\x20\t]*$")
_CHECKED = re.compile(r"(?<![A-Za-z0-9])gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None where it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the values that fill the data exactly; None where the lengths do not add up."""
    items, i = [], 0
    while i < len(data):
        if i + 2 > len(data):
            return None
        tag, n = data[i], data[i + 1]
        i += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or i + k > len(data) or data[i] == 0:
                return None
            n = int.from_bytes(data[i : i + k], "big")
            if n < 0x80:
                return None
            i += k
        if i + n > len(data):
            return None
        items.append((tag, data[i : i + n]))
        i += n
    return items


def is_der_key(data: bytes) -> bool:
    """Whether the data is one SEQUENCE that has the shape of a private or public key."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = der_items(top[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if tags[0] == 0x02 and len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return True  # the numbers of an RSA private key
    if tags[0] == 0x02 and 5 <= len(tags) <= 6 and set(tags) == {0x02}:
        return True  # those of a DSA key
    if tags[:2] == [0x02, 0x04] and parts[0][1] == b"\x01":
        return True  # an elliptic-curve private key
    if tags[:3] == [0x02, 0x30, 0x04] or tags[:2] == [0x30, 0x03] or tags[:2] == [0x30, 0x04]:  # with an algorithm's identifier
        algorithm = der_items(parts[tags.index(0x30)][1])
        if not algorithm or algorithm[0][0] != 0x06:
            return False
        if tags[0] == 0x02:  # the octet string holds the private key, whose lengths must add up too
            return bool(der_items(parts[2][1]))
        return tags[1] == 0x04 or len(parts[1][1]) > 1 and parts[1][1][0] < 8  # a bit string begins with its unused bits
    return tags == [0x02, 0x02] and len(parts[0][1]) >= 64  # an RSA public key


def is_openssh(data: bytes) -> bool:
    """Whether the data is an OpenSSH private key, or a public one: fields with four-byte lengths to the end."""
    magic = b"openssh-key-v1\0"
    private = data.startswith(magic)
    fields, i = [], len(magic) if private else 0
    while i < len(data):
        if private and len(fields) == 3:
            i += 4  # the number of keys
            private = False
            continue
        n = int.from_bytes(data[i : i + 4], "big")
        if i + 4 + n > len(data):
            return False
        fields.append(data[i + 4 : i + 4 + n])
        i += 4 + n
    if data.startswith(magic):
        return len(fields) >= 5
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]) is not None


def is_pem_key(label: str, body: str) -> bool:
    """Whether the body of a PEM block is a key, in clear or encrypted.

    A key encrypted by PEM headers is ciphertext without a structure: its headers must name a cipher and its first
    block, and its length must be whole blocks of eight bytes.
    """
    body = _BREAK.sub("\n", body)
    data = decode64(re.sub(r"\s", "", _HEADER.sub("", body)))
    if not data:
        return False
    if _ENCRYPTED.search(body):
        return _CIPHER.search(body) is not None and len(data) % 8 == 0
    return is_der_key(data) or is_openssh(data) or "ENCRYPTED" in label and bool(der_items(data))


def is_signed_token(text: str) -> bool:
    """Whether the token's first part is a JSON object that names an algorithm; one nested too deep to parse is none."""
    head = decode64(text.split(".", 1)[0])
    try:
        header = json.loads(head) if head else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def checksum_fits(body: str) -> bool:
    """Whether the last six characters are the CRC-32 of the others, in base 62."""
    n, digits = zlib.crc32(body[:-6].encode()), ""
    while n:
        n, d = divmod(n, 62)
        digits = _BASE62[d] + digits
    return digits.rjust(6, "0") == body[-6:]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the base matches, each kind leftmost and non-overlapping, failing ones dropped after matching."""
    found = []
    lower = text
    if ":" in lower or "=" in lower:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]  # a run of 16 or more is found whole either way
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of candidates whose decoded structure holds."""
    found = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if is_pem_key(m[1], m[2]):
                found.append((m.start(), m.end(), "pem"))
    for m in _RUN.finditer(text):
        data = decode64(m[0])
        if data:
            if is_der_key(data):
                found.append((m.start(), m.end(), "der"))
            elif is_openssh(data):
                found.append((m.start(), m.end(), "openssh"))
    for m in _HEX_RUN.finditer(text):
        if is_der_key(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), "der"))
    if "eyJ" in text:
        found += [(m.start(), m.end(), "jwt") for m in _JWT.finditer(text) if is_signed_token(m[0])]
    if "gh" in text:
        found += [(m.start(), m.end(), "checked") for m in _CHECKED.finditer(text) if checksum_fits(m[1])]
    return found


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans by start, then kind, then end."""
    return sorted(spans, key=lambda s: (s[0], _RANK[s[2]], s[1]))


def written(spans: list[tuple[int, int, str]]) -> str:
    """The spans as kind:start:end, in order, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in in_order(spans))


def masked(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """The text with each stretch that spans cover replaced by the mask once."""
    out, at = [], 0
    covered: list[list[int]] = []
    for a, b, _ in in_order(spans):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    for a, b in covered:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, text_col: str = "text", mask: str | None = None) -> DataFrame:
    """Adds n_assign, n_access, n_hex, base_sha256, spans and n_spans; with a mask, also masked: the text without its secrets.

    Spans are kind:start:end in code points, the end exclusive. A null text counts as empty and stays null in masked.
    Rows are handled one by one: order, repeated rows and an empty table make no difference.
    """
    added = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())]
    if mask is not None:
        added.append(("masked", pa.string()))
    names = [n for n, _ in added]
    kept = [c for c in df.columns if c not in names or c == text_col]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                out: list[list] = [[] for _ in added]
                for text in batch.column(kept.index(text_col)).to_pylist():
                    base = base_spans(text or "")
                    spans = base + confirmed_spans(text or "")
                    kinds = [k for _, _, k in base]
                    row = [*map(kinds.count, KINDS[:3]), hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans)]
                    if mask is not None:
                        row.append(text and masked(text, spans, mask))
                    for o, v in zip(out, row):
                        o.append(v)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(o, t) for o, (_, t) in zip(out, added))], names=[*kept, *names])

    kinds = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long" + ", masked string" * (mask is not None)
    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), kinds]))
