"""Secret scans with structural confirmation.

Three plain patterns (assign, access, hex) are always reported. The kinds below
them are reported only after their bytes have been taken apart:

- base64, on one line or broken over lines, or hex must be one DER value whose
  nested lengths fit exactly and whose fields are those of a private key: a
  version and the numbers of RSA or DSA, SEC1, PKCS #8 plain or encrypted.
  Public keys and certificates are no secrets.
- an openssh-key-v1 file's cipher, key list and private part must fill its bytes;
  public keys of SSH are no secrets.
- a framed key holds one of these, or, with DEK-Info headers, whole blocks of a
  cipher and its initial vector.
- a signed token's header and payload must be JSON objects, and its header must
  name an algorithm.

One pass over the documents, without a shuffle. Offsets are code points. Time
grows with the text: what a candidate may read is bounded by its own lengths.

Cases: null text is empty; no match gives zero counts, the digest of the empty
string and an empty ``spans``; JSON nested too deeply to parse is no token;
repeated rows are scanned each for itself; an empty table gives no rows; extra
columns travel inside ``row``, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import table

#: In the order in which kinds with the same start are listed.
KINDS = ("assign", "access", "hex", "pem", "token", "der64", "ssh64", "derhex")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORD = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_FRAME = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_DEK_INFO = re.compile(r"DEK-Info: *[A-Z0-9-]+, *[0-9A-Fa-f]{16,}")
_HEADER = re.compile(r"[A-Za-z-]+: ")
_BASE64 = re.compile(r"[A-Za-z0-9+/]+={0,2}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
#: What base64 makes of the first bytes of a DER sequence of up to 64 KB, and of an openssh-key-v1 file.
_DER64 = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))M(?:I[IGH]|[A-H])[A-Za-z0-9+/]{29}")
_SSH64 = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))b3BlbnNzaC1rZXktdjE")
_DERHEX = re.compile(r"(?<![0-9A-Fa-f])30(?:82|81|[2-7])[0-9A-Fa-f]{60,}")
_RUN = re.compile(r"[A-Za-z0-9+/]+")
_BREAK = re.compile(r"(?:\r?\n|\\n)[ \t]*(?=[A-Za-z0-9+/])")
_SSH_MAGIC = b"openssh-key-v1\0"
_NEST = {0x30, 0x31, 0xA0, 0xA1}


def decoded(text: str, url: bool = False) -> bytes | None:
    """The bytes of a base64 text with or without its padding; None if it is none."""
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fits(data: bytes, begin: int = 0, end: int | None = None, depth: int = 0) -> int:
    """Number of DER elements in data[begin:end], nested ones included; 0 if the lengths don't fit exactly."""
    end = len(data) if end is None else end
    found, at = 0, begin
    while at < end:
        if at + 2 > end or depth > 12:
            return 0
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return 0
            size = int.from_bytes(data[at : at + n], "big")
            at += n
        if at + size > end or tag & 0x1F == 0x1F or not tag:
            return 0
        if tag in _NEST and size:
            inner = der_fits(data, at, at + size, depth + 1)
            if not inner:
                return 0
            found += inner
        found += 1
        at += size
    return found


def der_fields(data: bytes, begin: int, end: int) -> list[tuple[int, int, int]]:
    """(tag, begin, end) of the elements of data[begin:end], whose lengths fit."""
    out, at = [], begin
    while at < end:
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        out.append((tag, at, at + size))
        at += size
    return out


def is_private_der(data: bytes | None) -> bool:
    """One sequence that fills the bytes and has the fields of a private key."""
    if not data or len(data) < 24 or data[0] != 0x30 or der_fits(data) < 3 or len(outer := der_fields(data, 0, len(data))) != 1:
        return False
    fields = der_fields(data, *outer[0][1:])
    tags = [tag for tag, _, _ in fields]

    def names_algorithm(i: int) -> bool:
        return tags[i] == 0x30 and data[fields[i][1] : fields[i][1] + 1] == b"\x06"

    if tags[0] == 0x30:  # PKCS #8, encrypted
        return tags == [0x30, 0x04] and names_algorithm(0)
    version = data[fields[0][1] : fields[0][2]]
    if tags[0] != 0x02 or version not in (b"\0", b"\1"):
        return False
    numbers = len(tags) >= 5 and set(tags) == {0x02}
    pkcs8 = len(tags) >= 3 and tags[2] == 0x04 and names_algorithm(1)
    return numbers or pkcs8 or (version == b"\1" and len(tags) >= 2 and tags[1] == 0x04)


def ssh_key_size(data: bytes | None) -> int:
    """Bytes that an openssh-key-v1 file at the beginning of ``data`` takes; 0 if there is none."""
    if not data or not data.startswith(_SSH_MAGIC):
        return 0
    at = len(_SSH_MAGIC)

    def skip() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        return data[at - size : at] if at <= len(data) else None

    if not (cipher := skip()) or not cipher.isascii() or skip() is None or skip() is None:
        return 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= len(data):
        return 0
    for _ in range(keys + 1):  # the public keys and the private part
        if not (part := skip()):
            return 0
    # Whole blocks; what isn't encrypted begins with the same number twice.
    fits = len(part) % 8 == 0 and (cipher != b"none" or part[:4] == part[4:8])
    return at if fits else 0


def is_framed_key(body: str) -> bool:
    """What stands between the lines of a private key's frame; line ends may be written as \\n."""
    lines = [x.strip() for x in re.split(r"\r?\n|(?:\\r)?\\n", body)]
    head = [x for x in lines if _HEADER.match(x)]
    text = "".join(x for x in lines if not _HEADER.match(x)).replace(" ", "")
    if not _BASE64.fullmatch(text):
        return False
    data = decoded(text)
    if any(_DEK_INFO.fullmatch(x) for x in head):
        return bool(data) and len(data) % 8 == 0
    return is_private_der(data) or (bool(data) and ssh_key_size(data) == len(data))


def gathered(text: str, at: int, most: int | None = None) -> tuple[str, list[tuple[int, int]]]:
    """Base64 from ``at`` on, over line ends, up to ``most`` characters; and (characters so far, end) of each line.

    A line that begins another key file ends it.
    """
    out, ends, n = [], [], 0
    while most is None or n < most:
        run = _RUN.match(text, at, len(text) if most is None else at + most - n)
        if not run or (n and _SSH64.match(text, at)):
            break
        out.append(run[0])
        n, at = n + len(run[0]), run.end()
        ends.append((n, at))
        line = _BREAK.match(text, at)
        if not line:
            break
        at = line.end()
    return "".join(out), ends


def _whole(text: str, size: int, ends: list[tuple[int, int]]) -> int | None:
    """Where base64 of ``size`` bytes ends, if it ends with a line; its padding counts."""
    chars = -(-size * 4 // 3)
    end = next((at for n, at in ends if n == chars), None)
    if end is None:
        return None
    padded = end
    while padded < end + -chars % 4 and text[padded : padded + 1] == "=":
        padded += 1
    return padded if not _RUN.match(text, padded) and text[padded : padded + 1] != "=" else None


def der64_end(text: str, at: int) -> int | None:
    """Where the base64 of a private key that begins at ``at`` ends."""
    head = base64.b64decode(text[at : at + 8])
    more = head[1] & 0x7F if head[1] & 0x80 else 0
    size = 2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1])
    letters, ends = gathered(text, at, -(-size * 4 // 3))
    end = _whole(text, size, ends)
    return end if end is not None and is_private_der(decoded(letters)) else None


def ssh64_end(text: str, at: int) -> int | None:
    """Where the base64 of an openssh-key-v1 file that begins at ``at`` ends."""
    letters, ends = gathered(text, at)
    size = ssh_key_size(decoded(letters[: len(letters) // 4 * 4]) or b"") or ssh_key_size(decoded(letters))
    return _whole(text, size, ends) if size else None


def is_signed_token(header: str, payload: str) -> bool:
    """Both parts are base64 of JSON objects, and the header names an algorithm."""
    parts = []
    for x in (header, payload):
        try:
            parts.append(json.loads(decoded(x, url=True) or b""))
        except (ValueError, RecursionError):
            return False
    return all(isinstance(x, dict) for x in parts) and isinstance(parts[0].get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns."""
    out = []
    if _ASSIGN_WORD.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what is confirmed by its structure."""
    out = []
    if "-----BEGIN " in text:
        opened = None
        for m in _FRAME.finditer(text):
            if m[1] == "END" and opened and opened[2] == m[2] and is_framed_key(text[opened.end() : m.start()]):
                out.append((opened.start(), 3, m.end()))
            opened = m if m[1] == "BEGIN" else None
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text) if is_signed_token(m[1], m[2])]
    framed = [(begin, end) for begin, kind, end in out if kind == 3]
    bare = lambda m: not any(begin < m.start() < end for begin, end in framed)
    out += [(m.start(), 5, end) for m in _DER64.finditer(text) if (end := der64_end(text, m.start())) and bare(m)]
    if "b3BlbnNzaC1rZXktdjE" in text:
        out += [(m.start(), 6, end) for m in _SSH64.finditer(text) if (end := ssh64_end(text, m.start())) and bare(m)]
    out += [(m.start(), 7, m.end()) for m in _DERHEX.finditer(text) if len(m[0]) % 2 == 0 and is_private_der(bytes.fromhex(m[0]))]
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        counts: tuple[list, ...] = ([], [], [])
        digests, spans = [], []
        for text in batch["_text"].to_pylist():
            base = base_spans(text or "")
            more = confirmed_spans(text or "")
            for kind, to in enumerate(counts):
                to.append(sum(x[1] == kind for x in base))
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest() if base else empty)
            spans.append(listed(base + more))
        names = [x for x in batch.schema.names if x != "_text"]
        new = {"n_assign": pa.array(counts[0], pa.int64()), "n_access": pa.array(counts[1], pa.int64()), "n_hex": pa.array(counts[2], pa.int64()), "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())}
        yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), *new.values()], [*names, *new])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = True) -> DataFrame:
    """Returns ``row`` (the input row, if ``with_rows``), ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` (kind:start:end, comma-joined)."""
    asked = docs.select(*[F.struct("*").alias("row")] * with_rows, F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    schema = asked.drop("_text").schema
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    return asked.mapInArrow(_scan, schema.add("base_sha256", "string").add("spans", "string"))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), with_rows=False)
