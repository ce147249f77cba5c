"""Secrets in texts, weak ones linked by what stands near them (operator 7).

Strong patterns are reported on their own. A weak candidate - an identifier, a
bare secret or an endpoint - means nothing alone. It is reported only where
complementary parts of one credential share a scope: an identifier with a
secret, or a secret with an endpoint. Scopes are stretches of neighbouring
characters; parts are joined by their positions in one sorted pass. User and
secret of a URL are parts of their own, and its query may hold a bare secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

BASE_KINDS = ("assign", "access", "hex")
LINKED_KINDS = ("linked_identifier", "linked_secret", "linked_endpoint")
KINDS = (*BASE_KINDS, *LINKED_KINDS)
SCOPE = 300  # characters between the parts of one credential, at most
LEAST_ENTROPY = 3.0  # bits per character of a bare secret

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are whole, so the length may stand here

# Words without which ASSIGN can't match; finding them is far cheaper.
_SIGNS = ("passw", "secret", "token", "api")

IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9_])(?:user(?:_?name|_?id)?|login|account(?:_?name|_?id)?|client_?id|tenant_?id|(?:access_)?key_?id)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9][A-Za-z0-9_.@+-]{2,})""",
    re.I | re.A,
)
BARE_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
# Endpoints are found by what can't be missing in them, and read to the left
# from there: a pattern that starts anywhere takes quadratic time on long runs.
_URL = re.compile(r"""://[^\s"'<>]+""")
_PORT = re.compile(r":\d{2,5}(?!\d)", re.A)
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_HOST = _SCHEME - {"+"}
_ALNUM = _SCHEME - set("+.-")
_LETTERS = _ALNUM - set("0123456789")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches that don't overlap, per kind, with the failing ones dropped."""
    found: list[Span] = []
    lower = text.lower()
    # Lower-casing may change lengths, never the presence of these ASCII words.
    if any(sign in lower for sign in _SIGNS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _looks_random(text: str) -> bool:
    kinds = sum(any(map(test, text)) for test in (str.islower, str.isupper, str.isdigit))
    return kinds >= 2 and any(map(str.isdigit, text)) and entropy(text) >= LEAST_ENTROPY


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same characters as sorted stretches that don't overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _meets(stretches: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect_left(stretches, (end, 0)) - 1
    return at >= 0 and stretches[at][1] > start


def _run_before(text: str, end: int, least: int, allowed: frozenset) -> int:
    """Where the characters of ``allowed`` before ``end`` begin, not before ``least``."""
    while end > least and text[end - 1] in allowed:
        end -= 1
    return end


def _scheme_start(text: str, end: int, least: int) -> int | None:
    """The first letter of a run that no letter or digit precedes."""
    for k in range(_run_before(text, end, least, _SCHEME), end):
        if text[k] in _LETTERS and (k == 0 or text[k - 1] not in _ALNUM):
            return k
    return None


def _host_start(text: str, end: int, least: int) -> int | None:
    """Where the longest row of labels starts that ends here with two letters or more."""
    first = _run_before(text, end, least, _HOST)
    labels = text[first:end].split(".")
    if len(labels[-1]) < 2 or not set(labels[-1]) <= _LETTERS:
        return None
    k = len(labels) - 1
    while k > 0 and labels[k - 1]:
        k -= 1
    # No letter or digit stands before it, nor where an earlier match ends.
    for start in range(end - len(".".join(labels[k:])), end - len(labels[-1]) - 1):
        if text[start] != "." and (start == 0 or text[start - 1] not in _ALNUM):
            return start
    return None


def endpoints_of(text: str) -> list[tuple[int, int]]:
    """URLs, and hosts with a port: leftmost ones that don't overlap."""
    signs = [(m.start(), _URL, _scheme_start) for m in re.finditer("://", text)] + [(m.start(), _PORT, _host_start) for m in _PORT.finditer(text)]
    found: list[tuple[int, int]] = []
    after = 0
    for at, pattern, find in sorted(signs, key=lambda x: x[0]):
        if at < after:
            continue
        start = find(text, at, after)
        match = pattern.match(text, at) if start is not None else None
        if match:
            found.append((start, match.end()))
            after = match.end()
    return found


_CREDENTIALS = re.compile(r"""://(?:([^\s/?#:@"'<>]+)?:)?([^\s/?#@"'<>]+)@""")


_QUERY_VALUE = re.compile(r"[?&;][^=&;\s]*=([A-Za-z0-9+/_-]{20,}={0,2})(?![A-Za-z0-9+/_=-])")


def parts_of(text: str, start: int, end: int) -> tuple[tuple[int, int], tuple[int, int] | None, list[tuple[int, int]]]:
    """A URL's place without its credentials and its query; its user; its secrets."""
    place, user, secrets = (start, end), None, []
    found = _CREDENTIALS.search(text, start, end)
    if found and text.find("/", start, found.start()) < 0:
        place = (found.end(), end)
        if text[found.start(2) - 1] == ":":
            user = found.span(1) if found[1] else None
            secrets.append(found.span(2))
        else:
            user = found.span(2)
    query = text.find("?", place[0], end)
    if query > place[0]:
        place = (place[0], query)
        secrets += [m.span(1) for m in _QUERY_VALUE.finditer(text, query, end) if _looks_random(m[1])]
    return place, user, secrets


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates that have a complementary part in their scope.

    Strong matches complement weak ones; they are not reported again.
    """
    if not any(sign in text for sign in (":", "=")) and not any(kind == "access" for kind, _, _ in base):
        return []  # no identifier and no endpoint without one of these
    identifiers = [(m.start(1), m.end(1), True) for m in IDENTIFIER.finditer(text)]
    cut = [parts_of(text, *x) for x in endpoints_of(text)]
    endpoints = [(*place, True) for place, _, _ in cut]
    identifiers += [(*user, True) for _, user, _ in cut if user]
    strong_ids = [(s, e, False) for kind, s, e in base if kind == "access"]
    if not identifiers and not endpoints and not strong_ids:
        return []
    strong, places = _united([(s, e) for _, s, e in base]), _united([(s, e) for s, e, _ in endpoints])
    secrets = [
        (m.start(), m.end(), True)
        for m in BARE_SECRET.finditer(text)
        if not _meets(strong, m.start(), m.end()) and not _meets(places, m.start(), m.end()) and _looks_random(m[0])
    ]
    named = [x for _, _, found in cut for x in found if not _meets(strong, *x)]
    secrets = [x for x in secrets if not _meets(_united(named), *x[:2])] + [(*x, True) for x in named]
    secrets += [(s, e, False) for kind, s, e in base if kind in ("assign", "hex")]
    # An identifier's own value is not its secret.
    own = {(s, e) for s, e, _ in identifiers}
    secrets = sorted(x for x in secrets if x[:2] not in own)
    all_ids, endpoints = sorted(identifiers + strong_ids), sorted(endpoints)

    def near(part: tuple[int, int, bool], firsts: list[int], furthest: list[int]) -> bool:
        """Does one of the others, which are sorted, come within the scope?"""
        before = bisect_right(firsts, part[1] + SCOPE)
        return before > 0 and furthest[before - 1] >= part[0] - SCOPE

    def index(parts: list) -> tuple:
        return [p[0] for p in parts], list(accumulate((p[1] for p in parts), max))

    ids, keys, ends = index(all_ids), index(secrets), index(endpoints)
    out: list[Span] = []
    out += [("linked_identifier", s, e) for s, e, weak in all_ids if weak and not _meets(strong, s, e) and near((s, e, weak), *keys)]
    out += [("linked_secret", s, e) for s, e, weak in secrets if weak and (near((s, e, weak), *ids) or near((s, e, weak), *ends))]
    out += [("linked_endpoint", s, e) for s, e, weak in endpoints if near((s, e, weak), *keys)]
    return out


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], [], [], []]
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            linked = linked_spans(text or "", base)
            counts = Counter(kind for kind, _, _ in base)
            values = [counts[k] for k in BASE_KINDS] + [hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + linked), len(linked)]
            for column, value in zip(rows, values):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(rows, types))], names)


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts, ``base_sha256``, ``spans`` and ``n_linked`` for every row.

    ``spans`` are ``kind:start:end`` in code points, end exclusive. A NULL text
    counts as empty. Rows are scanned one by one, whole: repeated rows agree,
    an empty table gives no rows.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
    )
